"""One-pass matching of a whole phrase dictionary: a multi-pattern automaton over the bytes of Arrow batches of texts.

The phrases' prefixes are the states.  Level by level (all prefixes of one length at once) the automaton gets for every
state and byte the next state – that of the longest suffix of what was read which is a prefix of a phrase – and for every
state the phrases that end there.  A batch of texts is scanned in lockstep: one vector holds the state of every lane and
takes one byte a step.  A lane is a text, or a part of a long one that starts as many bytes early as the longest phrase
has, so the work is linear in the texts' bytes whatever the number of phrases, and no text runs alone.

Bytes of UTF-8 match where characters match.  Dictionaries whose table would pass ``TABLE_BYTES`` are scanned as several
automata one after another.  The empty phrase is in every text, null texts hold none.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TABLE_BYTES = 64 << 20
LANE_BYTES = 1024
_BATCH_BYTES = 4 << 20


class Automaton:
    """Next states ``step[state * symbols + symbol]`` and the phrases that end in a state."""

    def __init__(self, phrases: list[bytes], numbers: list[int]):
        """Distinct phrases that aren't empty, and the number that a match of each reports."""
        lengths = np.array([len(p) for p in phrases], np.int64)
        order = np.argsort(-lengths, kind="stable")
        lengths, number = lengths[order], np.array(numbers, np.int64)[order]
        data = np.frombuffer(b"".join(phrases[i] for i in order.tolist()), np.uint8)
        first = np.cumsum(lengths) - lengths
        seen = np.unique(data)
        self.symbol = np.full(256, len(seen), np.int64)  # bytes of no phrase share a symbol that leads to the root
        self.symbol[seen] = np.arange(len(seen))
        self.longest = int(lengths[0]) if len(lengths) else 0
        a = self.symbols = len(seen) + 1

        # prefixes level by level
        state = np.zeros(len(lengths), np.int64)
        levels, total = [], 1
        for depth in range(self.longest):
            n = int(np.searchsorted(-lengths, -depth))  # phrases longer than depth
            key, inverse = np.unique(state[:n] * a + self.symbol[data[first[:n] + depth]], return_inverse=True)
            levels.append((key // a, key % a, total))
            state[:n] = total + inverse
            total += len(key)
        ends = np.full(total, -1, np.int64)  # the phrase that is the state
        ends[state] = number
        step = np.zeros((total, a), np.int32)
        suffix = np.zeros(total, np.int64)  # the longest proper suffix that is a state
        link = np.zeros(total, np.int64)  # the longest proper suffix that is a phrase, or the root
        for parent, symbol, start in levels:
            child = start + np.arange(len(parent))
            suffix[child] = np.where(parent > 0, step[suffix[parent], symbol], 0)
            step[parent, symbol] = child
            shorter = suffix[child]
            link[child] = np.where(ends[shorter] >= 0, shorter, link[shorter])
            # their own children aren't placed yet: until then they go where their suffix goes
            step[child] = step[shorter]
        self.step, self.ends, self.link = step.reshape(-1), ends, link
        self.hits = (ends >= 0) | (link > 0)

    def matches(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, phrase number): the distinct phrases of texts that are ranges of ``data``."""
        if not self.longest or not len(start):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        lanes = np.maximum(1, -(-length // LANE_BYTES))
        text = np.repeat(np.arange(len(start)), lanes)
        begin = (np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)) * LANE_BYTES
        end = np.minimum(begin + LANE_BYTES, length[text])
        begin = np.maximum(begin - self.longest + 1, 0)
        size = end - begin
        order = np.argsort(-size, kind="stable")
        text, size, at = text[order], size[order], (start[text] + begin)[order]
        symbol = self.symbol[data] if len(data) else np.empty(0, np.int64)
        state = np.zeros(len(text), np.int64)
        n_states = len(self.ends)
        found = []
        for k in range(int(size[0])):
            n = int(np.searchsorted(-size, -k))  # lanes longer than k
            state[:n] = self.step[state[:n] * self.symbols + symbol[at[:n] + k]]
            some = np.nonzero(self.hits[state[:n]])[0]
            if len(some):
                found.append(text[some] * n_states + state[some])
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        key = np.unique(np.concatenate(found))
        who, at_state = key // n_states, key % n_states
        out_text, out_phrase = [], []
        while len(who):
            own = self.ends[at_state]
            out_text.append(who[own >= 0])
            out_phrase.append(own[own >= 0])
            who, at_state = who[self.link[at_state] > 0], self.link[at_state[self.link[at_state] > 0]]
        return np.concatenate(out_text), np.concatenate(out_phrase)


class PhraseMatcher:
    """Finds entries (category, phrase, tag) in texts; travels as the entries and is compiled once in a worker."""

    def __init__(self, entries: list[tuple[str, str, str]], categories: list[str]):
        self.entries = sorted(set(entries))
        self.categories = categories

    def __getstate__(self):
        return {"entries": self.entries, "categories": self.categories}

    @cached_property
    def compiled(self):
        """(automata, category of a phrase's entries, tag of them, entries by phrase, entries of the empty phrase)."""
        number = {c: k for k, c in enumerate(self.categories)}
        entries = [e for e in self.entries if e[0] in number]
        phrases = sorted({p for _, p, _ in entries if p})
        of_phrase = {p: k for k, p in enumerate(phrases)}
        tags = sorted({t for _, _, t in entries})
        rank = {t: k for k, t in enumerate(tags)}
        rows = sorted((of_phrase.get(p, -1), number[c], rank[t]) for c, p, t in entries)
        table = np.array(rows, np.int64).reshape(-1, 3)
        automata, held, size = [], [], 0
        for p in phrases:
            raw = p.encode()
            # a state for every byte at most, a row of up to 257 numbers of 4 bytes for a state
            if held and (size + len(raw)) * 1028 > TABLE_BYTES:
                automata.append(Automaton([x.encode() for x in held], [of_phrase[x] for x in held]))
                held, size = [], 0
            held.append(p)
            size += len(raw)
        if held:
            automata.append(Automaton([x.encode() for x in held], [of_phrase[x] for x in held]))
        return automata, table, np.searchsorted(table[:, 0], np.arange(-1, len(phrases) + 1)), tags

    def cells(self, texts: pa.Array) -> pa.StructArray:
        """A struct of a field a category: the sorted distinct tags whose phrases are in the text, comma-joined, or null."""
        automata, table, first, tags = self.compiled
        texts = texts.cast(pa.large_binary())
        parts, at = [], 0
        while at < len(texts):
            end, size = at, 0
            lengths = pc.fill_null(pc.binary_length(texts[at : at + 65536]), 0).to_pylist()
            while end - at < len(lengths) and (end == at or size + lengths[end - at] <= _BATCH_BYTES):
                size += lengths[end - at]
                end += 1
            parts.append(self._some(texts[at:end], automata, table, first, tags))
            at = end
        columns = [[v for p in parts for v in p[k]] for k in range(len(self.categories))]
        return pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in columns], names=[f"c{k}" for k in range(len(self.categories))])

    def _some(self, texts, automata, table, first, tags):
        n, n_tags = len(texts), max(1, len(tags))
        known = np.nonzero(texts.is_valid().to_numpy(zero_copy_only=False))[0]
        raw = [t if t is not None else b"" for t in texts.to_pylist()]
        data = np.frombuffer(b"".join(raw), np.uint8)
        length = np.fromiter(map(len, raw), np.int64, n)
        start = np.cumsum(length) - length
        found = [a.matches(data, start, length) for a in automata]
        empty = first[1] - first[0]  # entries of the empty phrase
        text = np.concatenate([np.repeat(known, 1 if empty else 0), *[f[0] for f in found]]).astype(np.int64)
        phrase = np.concatenate([np.full(len(known) if empty else 0, -1), *[f[1] for f in found]]).astype(np.int64)
        m = first[phrase + 2] - first[phrase + 1]
        entry = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m - first[phrase + 1], m)
        cell = np.unique((np.repeat(text, m) * len(self.categories) + table[entry, 1]) * n_tags + table[entry, 2])
        out = [[None] * n for _ in self.categories]
        where, tag = cell // n_tags, [tags[k] for k in (cell % n_tags).tolist()]
        edge = np.append(np.nonzero(np.append(True, np.diff(where) != 0))[0], len(where)) if len(where) else np.zeros(1, np.int64)
        for s, e in zip(edge.tolist(), edge[1:].tolist(), strict=False):
            i, c = divmod(int(where[s]), len(self.categories))
            out[c][i] = ",".join(tag[s:e])
        return out
