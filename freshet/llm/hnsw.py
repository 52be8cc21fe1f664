"""Hierarchical navigable small-world graph of one shard; searches move many queries in step (numpy)."""

from __future__ import annotations

import io

import numpy as np

#: Links of a node on the upper layers and on the lowest, beam of the construction.
LINKS, LOWEST_LINKS, BUILD_BEAM = 12, 24, 48
#: Queries that move together, and the widest beam; a wider one is a scan of the whole shard.
TOGETHER, WIDEST = 1024, 128
#: An audit takes every 64th query, or more, until it has so many true pairs.
AUDITS, ENOUGH_TRUE = (64, 32, 16, 8), 64
#: Single precision products of one pair differ by less than this with the shape of a block; an audit leaves out
#: pairs so near to the limit.
EDGE = 2e-6


class Graph:
    """Layers of neighbour lists over unit vectors; layer 0 holds all nodes."""

    def __init__(self, unit: np.ndarray, layers: list[np.ndarray] | None = None, entry: int = 0):
        self.unit, self.layers, self.entry = unit, layers or [], entry

    @classmethod
    def build(cls, unit: np.ndarray, seed: int = 7) -> Graph:
        n = len(unit)
        draw = np.random.default_rng(seed).random(n)
        level = np.minimum((-np.log(draw) / np.log(LINKS)).astype(int), 6)
        order = np.argsort(-level, kind="stable")
        self = cls(unit, [np.full((n, LOWEST_LINKS if k == 0 else LINKS), -1, np.int32) for k in range(level.max(initial=0) + 1)], int(order[0]) if n else 0)
        done = 1
        while done < n:  # twice as many nodes each time, none linked before its whole batch is searched
            batch = order[done : min(2 * done, done + 2048)]
            start = np.full(len(batch), self.entry)
            for k in range(len(self.layers) - 1, -1, -1):
                here = level[batch] >= k
                ids, sims = self.search(unit[batch], k, BUILD_BEAM if here.any() else 1, start)
                start = np.where(ids[:, 0] >= 0, ids[:, 0], start)
                if here.any():
                    self._link(k, batch[here], ids[here], sims[here])
            if k == 0:
                self._link_within(batch)
            done += len(batch)
        return self

    def _link_within(self, batch: np.ndarray) -> None:
        """Nodes of one batch have not seen each other: link each with the nearest of them too."""
        for begin in range(0, len(batch), 1024):
            part = batch[begin : begin + 1024]
            sims = self.unit[part] @ self.unit[batch].T
            sims[np.arange(len(part)), np.arange(begin, begin + len(part))] = -2
            near = np.argsort(-sims, axis=1)[:, : LINKS // 2]
            self._link(0, part, batch[near], np.take_along_axis(sims, near, 1))

    def _link(self, k: int, nodes: np.ndarray, ids: np.ndarray, sims: np.ndarray) -> None:
        table = self.layers[k]
        keep = self._spread(ids, sims)
        a = np.repeat(nodes, keep.sum(1))
        b = ids[keep]
        src, dst = np.concatenate((a, b)), np.concatenate((b, a))
        old = np.unique(src)
        held = table[old]
        src, dst = np.concatenate((src, np.repeat(old, held.shape[1]))), np.concatenate((dst, held.ravel()))
        real = dst >= 0
        src, dst = src[real], dst[real]
        pair = np.unique(src.astype(np.int64) * len(self.unit) + dst)
        src, dst = pair // len(self.unit), pair % len(self.unit)
        near = np.einsum("ij,ij->i", self.unit[src], self.unit[dst])
        best = np.lexsort((dst, -near, src))
        src, dst, near = src[best], dst[best], near[best]
        place = np.arange(len(src)) - np.searchsorted(src, src)
        width = table.shape[1]
        row = np.searchsorted(old, src)
        ok = place < 2 * width
        near_ids, near_sims = np.full((len(old), 2 * width), -1, np.int64), np.full((len(old), 2 * width), -2.0, np.float32)
        near_ids[row[ok], place[ok]], near_sims[row[ok], place[ok]] = dst[ok], near[ok]
        for i in range(0, len(old), 1024):
            part = slice(i, i + 1024)
            chosen = self._spread(near_ids[part], near_sims[part], width)
            first = np.argsort(~chosen, axis=1, kind="stable")[:, :width]  # spread ones, then the nearest
            table[old[part]] = np.take_along_axis(near_ids[part], first, 1)

    def _spread(self, ids: np.ndarray, sims: np.ndarray, most: int = LINKS) -> np.ndarray:
        """Of each row's candidates (best first): those nearer to the node than to one chosen before."""
        keep = np.zeros(ids.shape, bool)
        top = min(ids.shape[1], 2 * most)
        vectors = self.unit[np.maximum(ids[:, :top], 0)]
        among = np.einsum("qid,qjd->qij", vectors, vectors, optimize=True)
        count = np.zeros(len(ids), int)
        for i in range(top):
            blocked = ((among[:, i, :i] > sims[:, i, None]) & keep[:, :i]).any(1)
            keep[:, i] = (ids[:, i] >= 0) & ~blocked & (count < most)
            count += keep[:, i]
        return keep

    def search(self, queries: np.ndarray, k: int, beam: int, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Beams on layer k, best first: node ids (-1: none) and similarities."""
        out_ids, out_sims = np.full((len(queries), beam), -1, np.int64), np.full((len(queries), beam), -2.0, np.float32)
        for i in range(0, len(queries), TOGETHER):
            part = slice(i, i + TOGETHER)
            out_ids[part], out_sims[part] = self._search(queries[part], self.layers[k], beam, start[part])
        return out_ids, out_sims

    def _search(self, queries, table, beam, start):
        n = len(queries)
        ids, sims = np.full((n, beam), -1, np.int64), np.full((n, beam), -2.0, np.float32)
        fresh = np.zeros((n, beam), bool)
        ids[:, 0], fresh[:, 0] = start, True
        sims[:, 0] = np.einsum("ij,ij->i", queries, self.unit[start])
        live = np.arange(n)
        while len(live):
            score = np.where(fresh[live], sims[live], -3)
            best = score.argmax(1)
            going = score[np.arange(len(live)), best] > -3
            live, best = live[going], best[going]
            if not len(live):
                break
            fresh[live, best] = False
            near = table[ids[live, best]].astype(np.int64)
            value = np.einsum("qmd,qd->qm", self.unit[np.maximum(near, 0)], queries[live])
            known = (near[:, :, None] == ids[live][:, None, :]).any(2) | (near < 0)
            value[known] = -2
            all_ids = np.concatenate((ids[live], np.where(known, -1, near)), 1)
            all_sims = np.concatenate((sims[live], value), 1)
            all_fresh = np.concatenate((fresh[live], ~known), 1)
            top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            ids[live], sims[live], fresh[live] = (np.take_along_axis(x, top, 1) for x in (all_ids, all_sims, all_fresh))
        rank = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, rank, 1), np.take_along_axis(sims, rank, 1)

    def nearest(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        start = np.full(len(queries), self.entry)
        for k in range(len(self.layers) - 1, 0, -1):
            ids, _ = self.search(queries, k, 1, start)
            start = ids[:, 0]
        return self.search(queries, 0, beam, start)

    def scan(self, queries: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) of all pairs at least as similar, by comparing with every node."""
        pairs = [np.nonzero(queries[i : i + 512] @ self.unit.T >= least) for i in range(0, len(queries), 512)]
        if not pairs:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([q + 512 * i for i, (q, _) in enumerate(pairs)]), np.concatenate([x for _, x in pairs])

    def within(self, queries: np.ndarray, least: float, beam: int = 48, recall: float = 0.98, own: bool = False) -> tuple[np.ndarray, np.ndarray, int, int]:
        """(query, node) of the pairs at least as similar, and how many true pairs an audit knew and the graph found.

        Queries whose beam ends above ``least`` get a wider one. Every 64th query, or more of them (up to every
        8th) until they have ENOUGH_TRUE true pairs, is also compared with all nodes; if fewer than ``recall`` of
        these pairs were found, all beams are widened, at last to a scan of the whole shard. ``own``: the queries are
        the nodes; pairs of a node with itself are left out of the audit.
        """
        if not len(self.unit) or not len(queries):
            return np.empty(0, np.int64), np.empty(0, np.int64), 0, 0
        for every in AUDITS:
            sample = np.arange(0, len(queries), every)
            true_q, true_node = self.scan(queries[sample], least + EDGE)
            true_q = sample[true_q]
            if own:
                true_q, true_node = (x[true_q != true_node] for x in (true_q, true_node))
            if len(true_q) >= ENOUGH_TRUE:
                break
        truth = true_q * len(self.unit) + true_node
        while True:
            q, node = self._within(queries, least, beam)
            got = int(np.isin(truth, q * len(self.unit) + node).sum())
            if got >= recall * len(truth) or beam > WIDEST:
                return q, node, len(truth), got
            beam *= 2

    def _within(self, queries, least, beam):
        todo, parts = np.arange(len(queries)), []
        while len(todo) and beam <= WIDEST:
            ids, sims = self.nearest(queries[todo], beam)
            full = (ids[:, -1] >= 0) & (sims[:, -1] >= least)
            row, place = np.nonzero((sims >= least) & (ids >= 0) & ~full[:, None])
            parts.append((todo[row], ids[row, place]))
            todo, beam = todo[full], beam * 2
        if len(todo):
            q, node = self.scan(queries[todo], least)
            parts.append((todo[q], node))
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def dumps(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, entry=self.entry, **{f"layer{k}": x for k, x in enumerate(self.layers)})
        return out.getvalue()

    @classmethod
    def loads(cls, unit: np.ndarray, data: bytes) -> Graph:
        stored = np.load(io.BytesIO(data))
        return cls(unit, [stored[f"layer{k}"] for k in range(len(stored.files) - 1)], int(stored["entry"]))
