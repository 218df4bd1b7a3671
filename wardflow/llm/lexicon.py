"""A word lexicon as a minimal acyclic transducer in one file, read by memory mapping.

Equal suffixes share states. An arc carries a byte and an output; the outputs along a word's path
add up to the word's place in sorted order, and the ids of that place follow in the file::

    magic "WLEX", states, arcs, words, ids (u4 each)
    first arc of each state and the end (u4), 1 for final states (u1)
    labels of arcs (u1), targets (u4), outputs (u4)
    first id of each word and the end (u4), ids (u4)

Each part is padded to a multiple of 4 bytes; numbers are little-endian.
"""

from __future__ import annotations

import mmap
import struct
from collections.abc import Iterable

import numpy as np

MAGIC = b"WLEX"
HEADER = struct.Struct("<4sIIII")


class _State:
    __slots__ = ("arcs", "final", "place", "words")

    def __init__(self):
        self.arcs: dict[int, _State] = {}
        self.final, self.place, self.words = False, -1, 0

    def key(self) -> tuple:
        return self.final, tuple((label, id(state)) for label, state in self.arcs.items())


def build(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """The file of distinct words with their ids. Words are added in sorted order; what lies
    below the last common prefix can no longer change, and is merged with an equal state."""
    entries = sorted(entries)
    start, register = _State(), {}
    path: list[tuple[_State, int, _State]] = []
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth:
            parent, label, child = path.pop()
            parent.arcs[label] = register.setdefault(child.key(), child)

    for k, (word, _) in enumerate(entries):
        if k and word == last:
            raise ValueError(f"{word!r} comes twice")
        common = 0
        for a, b in zip(word, last):
            if a != b:
                break
            common += 1
        close(common)
        state = path[-1][2] if path else start
        for label in word[common:]:
            child = _State()
            state.arcs[label] = child
            path.append((state, label, child))
            state = child
        state.final = True
        last = word
    close(0)

    states: list[_State] = [start]
    start.place = 0
    for state in states:  # grows while it is read
        for child in state.arcs.values():
            if child.place < 0:
                child.place = len(states)
                states.append(child)
    order, seen = [], set()
    stack = [(start, False)]
    while stack:  # a state after all that it reaches
        state, done = stack.pop()
        if done:
            order.append(state)
        elif state.place not in seen:
            seen.add(state.place)
            stack.append((state, True))
            stack += [(child, False) for child in state.arcs.values()]
    for state in order:
        state.words = state.final + sum(child.words for child in state.arcs.values())
    first, labels, targets, outputs = [0], bytearray(), [], []
    for state in states:
        before = int(state.final)
        for label, child in state.arcs.items():
            labels.append(label)
            targets.append(child.place)
            outputs.append(before)
            before += child.words
        first.append(len(labels))
    ends = np.cumsum([0, *(len(ids) for _, ids in entries)])
    ids = [i for _, own in entries for i in own]
    parts = [
        np.array(first, "<u4"), np.array([s.final for s in states], "u1"), np.frombuffer(bytes(labels), "u1"),
        np.array(targets, "<u4"), np.array(outputs, "<u4"), ends.astype("<u4"), np.array(ids, "<u4"),
    ]
    padded = [p.tobytes() + b"\0" * (-p.nbytes % 4) for p in parts]
    return HEADER.pack(MAGIC, len(states), len(labels), len(entries), len(ids)) + b"".join(padded)


class Lexicon:
    """A mapped lexicon file; ``ids`` of a word, or None."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        magic, states, arcs, words, ids = HEADER.unpack_from(self.map)
        if magic != MAGIC:
            raise ValueError(f"{path} is no lexicon")
        self.words = words
        view, at = memoryview(self.map), HEADER.size

        def part(count: int, width: int) -> memoryview:
            nonlocal at
            own = view[at : at + count * width]
            at += count * width + -(count * width) % 4
            return own.cast("I") if width == 4 else own

        self.first, self.final = part(states + 1, 4), part(states, 1)
        self.labels_at = at
        part(arcs, 1)
        self.targets, self.outputs = part(arcs, 4), part(arcs, 4)
        self.ends, self.every = part(words + 1, 4), part(ids, 4)

    def place(self, word: bytes) -> int:
        """The word's place in sorted order, or -1."""
        state, place, find, base = 0, 0, self.map.find, self.labels_at
        first, targets, outputs = self.first, self.targets, self.outputs
        for k in range(len(word)):
            arc = find(word[k : k + 1], base + first[state], base + first[state + 1]) - base
            if arc < 0:
                return -1
            place += outputs[arc]
            state = targets[arc]
        return place if self.final[state] else -1

    def ids(self, word: bytes) -> list[int] | None:
        place = self.place(word)
        return None if place < 0 else self.every[self.ends[place] : self.ends[place + 1]].tolist()
