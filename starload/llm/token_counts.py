"""Edit-aware token counts: a segment tree of pre-token counts per document, of which an edit touches only a part.

The leaves of a document's tree are its pre-tokens (the vocabulary's own pattern): their lengths in characters and in
ids; inner nodes hold both sums. The pattern looks back at nothing and ahead by two characters at most ('re, 've and 'll,
and white space before a word), so an edit can change no pre-token that ends two characters before it, and once the new scan meets an old boundary behind the edit,
everything after is as it was. So an edit descends the tree to its leaves, scans and encodes again from the last safe
boundary to the first common one, and adds the difference of the sums along the path, instead of encoding the text again.

An edit is (position, removed, inserted): at a character position of the text as the edits before it left it, so many
characters go and a string comes. Positions and lengths are cut to the text; null parts count as 0 or empty.

Defined results: a null text counts as empty, a null or empty list of edits changes nothing, repeated rows each keep
their row, an empty table gives none; columns other than doc_id, text and edits are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm.common import prepare, slices
from starload.llm.tokens import Encoder, encoder, vocabulary_path

COUNTS = "doc_id long, n_tokens long, n_tokens_edited long, n_edits long, n_leaves long, n_leaves_encoded long, n_chars_edited long"
EDIT = "array<struct<position: long, removed: long, inserted: string>>"


@lru_cache(maxsize=1)
def pattern():
    """Fixed value: the pre-token pattern of the vocabulary."""
    import regex

    return regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


class Tree:
    """Leaves in chunks of at most ``CHUNK``; a node has the sums (characters, ids) of the chunks below it."""

    CHUNK = 64

    def __init__(self, text: str, encode: Encoder) -> None:
        self.text, self.encode = text, encode
        self.encoded = 0
        pieces = pattern().findall(text)
        leaves = list(zip(map(len, pieces), [len(b) // 4 for b in map(encode.units.__getitem__, pieces)], strict=True))
        self.chunks = [leaves[i : i + self.CHUNK] for i in range(0, len(leaves), self.CHUNK)]
        self._build()

    def _ids(self, piece: str) -> int:
        return len(self.encode.units[piece]) // 4

    def _build(self) -> None:
        self.size = 1 << max(0, len(self.chunks) - 1).bit_length()
        self.chars, self.ids = [0] * (2 * self.size), [0] * (2 * self.size)
        for i, c in enumerate(self.chunks):
            self.chars[self.size + i], self.ids[self.size + i] = sum(x for x, _ in c), sum(x for _, x in c)
        for i in range(self.size - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.ids[i] = self.ids[2 * i] + self.ids[2 * i + 1]

    @property
    def total(self) -> int:
        return self.ids[1]

    @property
    def leaves(self) -> int:
        return sum(map(len, self.chunks))

    def _find(self, position: int) -> tuple[int, int, int]:
        """(chunk, leaf, its first character) of the leaf that holds ``position``, or the last leaf."""
        node, at = 1, 0
        while node < self.size:
            node *= 2
            if position - at >= self.chars[node] and self.chars[node + 1]:
                at += self.chars[node]
                node += 1
        chunk = node - self.size
        leaves = self.chunks[chunk]
        for k, (n, _) in enumerate(leaves):
            if position < at + n or k == len(leaves) - 1:
                return chunk, k, at
            at += n
        raise AssertionError("an empty chunk")

    def edit(self, position: int, removed: int, inserted: str) -> None:
        old = self.text
        position = min(max(0, position), len(old))
        removed = min(max(0, removed), len(old) - position)
        self.text = new = old[:position] + inserted + old[position + removed :]
        if not self.chunks:
            self.__init_again()
            return
        # a leaf that ends one character before the edit or later may have looked at what changes
        chunk, leaf, at = self._find(max(0, position - 2))
        stop, shift = position + removed, len(inserted) - removed
        last, k, end = chunk, leaf, at
        fresh: list[tuple[int, int]] = []
        scan = pattern().finditer(new, at)
        here = at
        while True:
            # old boundaries up to the scan's place, seen from the new text
            while last < len(self.chunks) and end + shift < here or last < len(self.chunks) and end < stop:
                end += self.chunks[last][k][0]
                k += 1
                if k == len(self.chunks[last]):
                    last, k = last + 1, 0
            if end >= stop and end + shift == here and here >= position + len(inserted):
                break
            m = next(scan, None)
            if m is None:
                last, k = len(self.chunks), 0
                break
            fresh.append((m.end() - m.start(), self._ids(m.group())))
            self.encoded += 1
            here = m.end()
        self._replace(chunk, leaf, last, k, fresh)

    def __init_again(self) -> None:
        encoded, text = self.encoded, self.text
        self.__init__(text, self.encode)
        self.encoded = encoded + self.leaves

    def _replace(self, chunk: int, leaf: int, last: int, k: int, fresh: list[tuple[int, int]]) -> None:
        """Leaves from (chunk, leaf) up to (last, k), which stays, become ``fresh``."""
        tail = self.chunks[last][k:] if last < len(self.chunks) else []
        merged = self.chunks[chunk][:leaf] + fresh + tail
        through = last if last < len(self.chunks) else last - 1
        parts = [merged[i : i + self.CHUNK] for i in range(0, len(merged), self.CHUNK)]
        if len(parts) == through - chunk + 1 or (len(merged) and chunk == through and len(merged) <= 2 * self.CHUNK):
            if len(parts) != through - chunk + 1:
                parts = [merged]
            for i, p in enumerate(parts, chunk):
                self.chunks[i] = p
                self._sum(i)
        else:
            self.chunks[chunk : through + 1] = parts
            self._build()

    def _sum(self, chunk: int) -> None:
        node = self.size + chunk
        chars, ids = sum(x for x, _ in self.chunks[chunk]) - self.chars[node], sum(x for _, x in self.chunks[chunk]) - self.ids[node]
        while node:
            self.chars[node] += chars
            self.ids[node] += ids
            node //= 2


def _counts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch, text in slices(batches, "text", tokens=True):
            rows = []
            for doc_id, t, edits in zip(batch.column("doc_id").to_pylist(), text.to_pylist(), batch.column("edits").to_pylist(), strict=True):
                encode.units.turn()
                tree = Tree(t, encode)
                before, leaves = tree.total, tree.leaves
                edits = [e for e in edits or [] if e is not None]
                for e in edits:
                    tree.edit(e["position"] or 0, e["removed"] or 0, e["inserted"] or "")
                rows.append((doc_id, before, tree.total, len(edits), leaves, tree.encoded, len(tree.text)))
            names = [c.split()[0] for c in COUNTS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)

    return run


def edited_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Token counts of each text before and after its ``edits`` (a column of type ``EDIT``), with what was encoded again."""
    prepare(docs.sparkSession)
    rows = docs.select("doc_id", "text", F.col("edits").cast(EDIT).alias("edits"))
    return rows.mapInArrow(_counts(vocabulary or vocabulary_path()), COUNTS)


def with_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """Documents with the edits of a table (doc_id, number, position, removed, inserted), in the order of ``number``."""
    one = F.struct("number", "position", "removed", "inserted")
    lists = edits.groupBy("doc_id").agg(F.sort_array(F.collect_list(one)).alias("listed"))
    lists = lists.select(F.col("doc_id").alias("edited_id"), F.transform("listed", lambda e: F.struct(e["position"].alias("position"), e["removed"].alias("removed"), e["inserted"].alias("inserted"))).alias("edits"))
    return docs.select("doc_id", "text").join(lists, F.col("doc_id").eqNullSafe(F.col("edited_id")), "left").drop("edited_id")
