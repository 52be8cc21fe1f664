"""Lexicon trie met by Levenshtein automata: words that begin with a term, give or take one edit.

A state is the set of (trie node, edits so far) that a word's letters can have led to. States and their
transitions are made when first needed and kept, so a word costs one look-up per letter.
"""

from __future__ import annotations

#: Terms shorter than this are matched exactly.
FUZZY_LENGTH = 5
MAX_STATES = 200_000
MAX_WORDS = 500_000


class LexiconTrie:
    def __init__(self, terms: list[str], edits: int = 1):
        self.terms, self.edits = terms, edits
        self.children: list[dict[str, int]] = [{}]
        self.ends: dict[int, int] = {}
        for number, term in enumerate(terms):
            node = 0
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                node = self.children[node][letter]
            self.ends[node] = number
        self.words: dict[str, tuple[int, int] | None] = {}
        self._reset()

    def _reset(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.accepts: list[tuple[int, int, int] | None] = []
        self.moves: list[dict[str, int]] = []
        self.start = self._state({0: 0})

    def _state(self, reached: dict[int, int]) -> int:
        """The state of these nodes (with their fewest edits), once letters of a term may be missing."""
        todo = list(reached)
        while todo:
            node = todo.pop()
            if reached[node] < self.edits:
                for child in self.children[node].values():
                    if reached.get(child, 99) > reached[node] + 1:
                        reached[child] = reached[node] + 1
                        todo.append(child)
        key = frozenset(reached.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
            found = [(e, -len(self.terms[self.ends[n]]), self.ends[n]) for n, e in reached.items() if n in self.ends]
            found = [x for x in found if x[0] == 0 or -x[1] >= FUZZY_LENGTH]
            self.accepts.append(min(found) if found else None)
        return self.states[key]

    def _move(self, state: int, letter: str) -> int:
        reached: dict[int, int] = {}
        for node, e in self.sets[state]:
            steps = [(self.children[node].get(letter), e)]
            if e < self.edits:
                steps += [(child, e + 1) for child in self.children[node].values()] + [(node, e + 1)]
            for to, cost in steps:
                if to is not None and reached.get(to, 99) > cost:
                    reached[to] = cost
        target = self._state(reached) if reached else -1
        self.moves[state][letter] = target
        return target

    def match(self, word: str) -> tuple[int, int] | None:
        """(term number, edits) of the best term that the word begins with: fewest edits, then longest."""
        if word in self.words:
            return self.words[word]
        if len(self.words) > MAX_WORDS:
            self.words.clear()
        if len(self.sets) > MAX_STATES:
            self._reset()
        state, best = self.start, None
        for letter in word:
            to = self.moves[state].get(letter)
            state = self._move(state, letter) if to is None else to
            if state < 0:
                break
            got = self.accepts[state]
            if got and (best is None or got < best):
                best = got
        self.words[word] = (best[2], best[0]) if best else None
        return self.words[word]
