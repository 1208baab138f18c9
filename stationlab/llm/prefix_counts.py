"""Token counts: exact number of tokens of every prefix of a text.

For byte-pair merges the encoding of a prefix of a piece is the encoding of a
shorter prefix plus one last token, and exactly one vocabulary token is a
valid last token.  ``PrefixTable`` walks a piece once, left to right, and
stores for every prefix that last token and the count (dynamic programming);
no prefix is encoded on its own.  Two tokens may stand side by side if no
merge joins the right edge of the first to the left edge of the second before
the merges that build either of them.

The counts of a whole text are the counts of its pieces laid end to end,
mended where a cut inside a text changes how its end is cut into pieces: in
runs of white space, in the contractions and inside special strings.  They are
kept as one signed 16-bit step per code point, so the number of tokens of any
prefix is a partial sum, and questions on truncation, budgets and windows
are answered without encoding again.

Defined results: null and empty texts have no steps and 0 tokens; equal rows
have equal results; other columns of the input are not read.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from stationlab.llm.common import column_bytes, column_list, fresh, slices, tokenizer_path
from stationlab.llm.word_tokens import Memory, byte_alphabet

# How the byte-level vocabulary cuts a text into pieces.
BYTE_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_CONTRACTIONS = ("'re", "'ve", "'ll")

VOCABULARY = "byte_bpe_50k.json"
STEP = np.dtype("<i2")


class Odd(Exception):
    """The part's pieces depend on its neighbours."""


class PrefixTable:
    def __init__(self, path: str):
        import regex
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        stands = {c: b for b, c in enumerate(byte_alphabet())}
        raw = {t: bytes(stands[c] for c in t) for t in spec["model"]["vocab"] if all(c in stands for c in t)}
        self.specials = [t["content"] for t in spec["added_tokens"]]
        ids = spec["model"]["vocab"]
        self.single = {raw[t]: i for t, i in ids.items() if t in raw and len(raw[t]) == 1}
        self.rank: dict = {}       # (left, right) -> place among the merges
        self.halves: dict = {}     # token -> (left, right, place)
        for place, merge in enumerate(spec["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            x, y = ids[a], ids[b]
            self.rank[x, y] = place
            self.halves.setdefault(ids[a + b], (x, y, place))
        self.edges_right: dict = {}
        self.edges_left: dict = {}
        self.pairs: dict = {}
        self.tokens = dict(self.single)
        for t, i in ids.items():
            if i in self.halves and t in raw and self._builds_itself(i):
                self.tokens[raw[t]] = i
        self.starts = dict.fromkeys((t[:k] for t in self.tokens for k in range(1, len(t))), -1) | self.tokens
        self.cut = regex.compile(BYTE_PIECES).findall
        self.pieces = Memory(self._piece)
        self.parts = Memory(self._part)
        self.part = self.parts.__getitem__
        self.runs = regex.compile(r"\s{2,}(?=\S)")
        self.apart = re.compile(r"(?<=\S) (?=\S)")

    def _spine(self, token: int, side: int) -> list:
        """(node, place of the merge that takes the node up) down one edge of the token."""
        known = self.edges_left if side == 0 else self.edges_right
        if (out := known.get(token)) is None:
            out, node, above = [], token, 1 << 60
            while True:
                out.append((node, above))
                if node not in self.halves:
                    break
                above = self.halves[node][2]
                node = self.halves[node][side]
            known[token] = out
        return out

    def _clash(self, a: int, b: int, below: int = 1 << 59) -> bool:
        """Some merge would join the edge of ``a`` to the edge of ``b`` first."""
        rank = self.rank
        for x, up_x in self._spine(a, 1):
            for y, up_y in self._spine(b, 0):
                r = rank.get((x, y))
                if r is not None and r < below and r < up_x and r <= up_y:
                    return True
        return False

    def _builds_itself(self, token: int) -> bool:
        x, y, place = self.halves[token]
        return not self._clash(x, y, place)

    def _piece(self, piece: str) -> bytes:
        """Steps of the counts at the code points of one piece."""
        data = piece.encode()
        n = len(data)
        starts, pairs = self.starts, self.pairs
        last, count = [-1] * (n + 1), [0] * (n + 1)
        for j in range(n):
            before, c = last[j], count[j] + 1
            for i in range(j + 1, n + 1):
                t = starts.get(data[j:i])
                if t is None:          # no token begins like this
                    break
                if t < 0 or last[i] >= 0:
                    continue
                if j:
                    ok = pairs.get(key := before << 20 | t)
                    if ok is None:
                        if len(pairs) > 600_000:        # about 60 MB
                            pairs.clear()
                        ok = pairs[key] = not self._clash(before, t)
                    if not ok:
                        continue
                last[i], count[i] = t, c
        if n == len(piece):
            steps = [b - a for a, b in zip(count, count[1:])]
        else:
            ends = [i for i in range(n + 1) if i == n or data[i] & 0xC0 != 0x80]
            steps = [count[b] - count[a] for a, b in zip(ends, ends[1:])]
        if piece in LONG_CONTRACTIONS:      # a cut after the second letter leaves two pieces
            c = 1 + int(np.frombuffer(self.pieces[piece[1:2]], STEP).sum())
            steps = [1, c - 1, sum(steps) - c]
        return array("h", steps).tobytes()

    def _part(self, part: str) -> bytes:
        """Steps of a part between single spaces, the space before it included."""
        if not part or part[0].isspace() or part[-1].isspace() or any(s in part for s in self.specials):
            raise Odd
        core = part.rstrip(".,")
        if core.isalpha():
            return self.pieces[" " + core] + self.pieces[part[len(core):]] if len(core) < len(part) else self.pieces[" " + part]
        return self._plain(" " + part)

    def _plain(self, text: str) -> bytes:
        """Steps of a text without special strings."""
        out = b"".join(map(self.pieces.__getitem__, self.cut(text)))
        if self.runs.search(text):
            steps = np.frombuffer(out, STEP).copy()
            for m in self.runs.finditer(text):
                run, end = m.group(), m.end()
                now = int(np.frombuffer(self.pieces[run[:-1]], STEP).sum()) + int(steps[end - 1])
                ends_here = int(np.frombuffer(self.pieces[run], STEP).sum())
                # up to the run's last but one code point its prefixes are single pieces already
                steps[end - 1] += ends_here - now
                steps[end] -= ends_here - now
            out = steps.tobytes()
        return out

    def _segment(self, text: str) -> bytes:
        """As ``_plain``, cut at single spaces so that parts met before are not walked again."""
        first, *rest = self.apart.split(text)
        return self._plain(first) + b"".join([self._plain(" " + p) for p in rest])

    def _special(self, before: str, special: str) -> bytes:
        """Steps inside a special string after ``before``; at its end it is one token."""
        tail = self.cut(before)[-1] if before else ""
        base = int(np.frombuffer(self._plain(tail), STEP).sum())
        counts = [int(np.frombuffer(self._plain(tail + special[:k]), STEP).sum()) for k in range(1, len(special))]
        counts = np.array([base, *counts, base + 1])
        return np.diff(counts).astype(STEP).tobytes()

    def steps(self, data: bytes | None) -> bytes:
        """One signed 16-bit step per code point."""
        if not data:
            return b""
        text = data.decode()
        parts = text.split(" ")
        first = parts[0]
        try:
            if not first or first[0].isspace() or first[-1].isspace() or any(s in first for s in self.specials):
                raise Odd
            tail = b"".join(map(self.part, parts[1:]))
            return self._plain(first) + tail
        except Odd:
            pass
        out, at = [], 0
        while at < len(text):
            where, special = min(((p, s) for s in self.specials if (p := text.find(s, at)) >= 0), default=(len(text), ""))
            if segment := text[at:where]:
                out.append(self._segment(segment))
            if special:
                out.append(self._special(segment, special))
            at = where + len(special)
        return b"".join(out)


def prefix_counts(docs: DataFrame, vocabulary: str | None = None, text: str = "text", steps: str = "token_steps",
                  keep_columns: list | None = None) -> DataFrame:
    """``docs`` with the column ``steps``: binary, one signed 16-bit little-endian step per code point.

    ``keep_columns`` names the columns kept beside it (default: all); the name
    of the new column is changed (a leading underscore) where it is taken.
    """
    path = vocabulary or tokenizer_path(VOCABULARY)
    cols = list(dict.fromkeys([*(docs.columns if keep_columns is None else keep_columns), text]))
    source = docs.select(*[F.col(f"`{c}`") for c in cols])
    name = fresh(source, steps)
    schema = StructType([*source.schema.fields, StructField(name, BinaryType())])

    def run(batches):
        table = shared_table(path)
        for batch in batches:
            for part in slices(batch, text):
                made = [table.steps(x) for x in column_bytes(part, text)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(made, pa.binary())], [*cols, name])

    return source.mapInArrow(run, schema)


_TABLES: dict = {}


def shared_table(path: str) -> PrefixTable:
    if path not in _TABLES:
        _TABLES[path] = PrefixTable(path)
    return _TABLES[path]


def counts_of(steps: bytes) -> np.ndarray:
    """Token counts after 0, 1, 2, ... code points."""
    return np.concatenate(([0], np.cumsum(np.frombuffer(steps, STEP), dtype=np.int64)))


def longest_within(steps: bytes, budget: int) -> int:
    """Code points of the longest prefix with at most ``budget`` tokens."""
    return int(np.flatnonzero(counts_of(steps) <= budget)[-1])


def token_totals(counted: DataFrame, vocab_column: str = "token_steps", limit: int = 512, budget: Column | int | None = None,
                 text: str = "text") -> DataFrame:
    """Per row of ``prefix_counts``: doc_id, n_bytes, n_tokens, over_limit, and kept_chars (code points of the
    longest prefix within the limit), all from the stored steps."""
    most = int(limit if budget is None else budget)

    def run(batches):
        for batch in batches:
            yield _totals(batch.column(batch.schema.get_field_index("doc_id")), column_bytes(batch, text),
                          column_list(batch, vocab_column), limit, most)

    return counted.mapInArrow(run, TOTALS)


TOTALS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, kept_chars long"


def _totals(doc_ids: pa.Array, texts: list, made: list, limit: int, most: int) -> pa.RecordBatch:
    totals = [int(np.frombuffer(s, STEP).sum()) for s in made]
    kept = [longest_within(s, most) if n > most else len(s) // 2 for s, n in zip(made, totals, strict=True)]
    return pa.RecordBatch.from_arrays(
        [doc_ids, pa.array([len(x) if x else 0 for x in texts], pa.int64()), pa.array(totals, pa.int64()),
         pa.array([n > limit for n in totals], pa.bool_()), pa.array(kept, pa.int64())], [c.split()[0] for c in TOTALS.split(", ")])


def count_tokens(docs: DataFrame, vocabulary: str | None = None, limit: int = 512, budget: int | None = None,
                 text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``token_totals`` of ``prefix_counts`` in one pass, where the steps themselves are not wanted."""
    path, most = vocabulary or tokenizer_path(VOCABULARY), limit if budget is None else budget
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batches):
        table = shared_table(path)
        for batch in batches:
            for part in slices(batch):
                texts = column_bytes(part, "text")
                yield _totals(part.column(0), texts, [table.steps(x) for x in texts], limit, most)

    return source.mapInArrow(run, TOTALS)
