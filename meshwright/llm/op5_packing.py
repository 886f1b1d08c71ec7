"""Sequence packing: first-fit decreasing over a tournament tree of bin capacities.

Every document becomes its token ids followed by one separator id, described by its number of tokens and the checksum of
each piece (cut at multiples of a sequence). Documents are dealt to randomised groups of bounded size; a group places
the remainders of its documents by first-fit decreasing, and its whole pieces get the sequence numbers after those. A group is
the unit of work and of recovery. One row per document is written and shuffled, never ids; pieces are made after the packing.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwright.llm.common import table, written

SEQUENCE = 1024
#: Documents that a group holds on average; a few thousand remainders are enough for full bins.
GROUP_DOCUMENTS = 4096
SEPARATOR = 0
DOCUMENTS = "doc_id long, doc_tokens long, crcs array<long>"


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


class ByteBpe:
    """Ids of a byte-level BPE, as the library's tokenizer gives them without special tokens of its own: an added token's string in a text is that token.

    ``ranks_file`` holds the same vocabulary as ``json_file`` in rank form, whose encoder gives equal ids
    several times faster (the tests compare both) for the text between added tokens; what that encoder can't take goes to the other.
    """

    def __init__(self, json_file: str, ranks_file: str | None):
        self.json_file, self.fast, self._slow, self.added, self.cut = json_file, None, None, {}, None
        if ranks_file:
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks_file, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            with open(json_file, encoding="utf-8") as f:
                added = json.load(f).get("added_tokens", [])
            if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
                return  # such tokens depend on their surroundings
            self.added = {t["content"]: t["id"] for t in added}
            if added:
                self.cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")")
            self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def slow(self, text: str) -> list[int]:
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.json_file)
        return self._slow.encode(text, add_special_tokens=False).ids

    def __call__(self, text: str) -> list[int]:
        if self.fast is None:
            return self.slow(text)
        try:
            if self.cut is None or not self.cut.search(text):
                return self.fast.encode_ordinary(text)
            ids = []
            for part in self.cut.split(text):
                ids += [self.added[part]] if part in self.added else self.fast.encode_ordinary(part)
            return ids
        except (KeyboardInterrupt, SystemExit):
            raise
        except BaseException:  # the encoder's panics are no Exception
            return self.slow(text)


_ENCODERS: dict[tuple, ByteBpe] = {}


def encoder(files: tuple[str, str | None]) -> ByteBpe:
    if files not in _ENCODERS:
        _ENCODERS[files] = ByteBpe(*files)
    return _ENCODERS[files]


class TournamentTree:
    """Largest free capacity over leaves; finds the first bin with room in O(log n)."""

    def __init__(self, bins: int, capacity: int):
        self.size = 1 << max(0, (max(1, bins) - 1).bit_length())
        self.best = [capacity] * (2 * self.size)

    def place(self, need: int) -> tuple[int, int]:
        """Put ``need`` in the first bin with room; returns (bin, offset from the capacity left before)."""
        best, i = self.best, 1
        while i < self.size:
            i *= 2
            if best[i] < need:
                i += 1
        left = best[i]
        found = i - self.size
        best[i] = left - need
        i //= 2
        while i:
            a, b = best[2 * i], best[2 * i + 1]
            best[i] = a if a > b else b
            i //= 2
        return found, left


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; ties keep their order."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree = TournamentTree(len(lengths), capacity)
    for i in np.argsort(-lengths, kind="stable"):
        need = int(lengths[i])
        bins[i], left = tree.place(need)
        offsets[i] = capacity - left
    return bins, offsets


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE, files: tuple[str, str | None] | None = None) -> DataFrame:
    """One row per document: doc_id, doc_tokens (with the separator), crcs (checksum of each piece). Ids pass as Arrow integers, so they stay exact beside nulls."""
    files = files or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(files)
        for batch in batches:
            counts, crcs = [], []
            for text in batch.column(1):
                ids = np.array([*encode(text.as_py()), SEPARATOR], "<u4")
                raw = memoryview(ids).cast("B")
                counts.append(len(ids))
                crcs.append([zlib.crc32(raw[4 * s : 4 * (s + sequence)]) for s in range(0, len(ids), sequence)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(crcs, pa.list_(pa.int64()))], ["doc_id", "doc_tokens", "crcs"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).mapInArrow(run, DOCUMENTS)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE, group_documents: int = GROUP_DOCUMENTS, files: tuple[str, str | None] | None = None) -> DataFrame:
    """Pack whole documents into sequences of at most ``sequence`` tokens: one row per piece.

    Null text counts as empty (one separator); a null id is kept as null; repeated rows are packed as often as
    they occur; a very long text has as many whole pieces as it needs, beside one remainder; an empty table gives no rows; other columns
    are ignored. A sequence that isn't full is padded to ``sequence`` unless its length is a power of two. ``sequence_id`` is unique over
    all groups: the group in the high bits, the sequence in it in the low 32.
    """
    # each row has a number of its own, so repeated rows and rows without an id are dealt like others; writing fixes the numbers
    rows = written(described(docs, id_col, text_col, sequence, files).withColumn("row", F.monotonically_increasing_id()), "described")
    groups = max(1, -(-rows.count() // group_documents))

    def place(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("row")
        total = rows.column("doc_tokens").to_numpy()
        rest, whole = total % sequence, total // sequence
        some = np.flatnonzero(rest)
        bins, offset = np.zeros(len(total), np.int64), np.zeros(len(total), np.int64)
        bins[some], offset[some] = first_fit_decreasing(rest[some], sequence)
        used = int(bins[some].max()) + 1 if len(some) else 0
        base = int(key[0].as_py()) << 32
        first = base + used + np.cumsum(whole) - whole
        return rows.select(["doc_id", "doc_tokens", "crcs"]).append_column("first", pa.array(first)).append_column("bin", pa.array(base + bins)).append_column("at", pa.array(offset))

    placed = rows.withColumn("grp", F.pmod(F.xxhash64("row", F.lit("pack")), F.lit(groups))).groupBy("grp").applyInArrow(place, DOCUMENTS + ", first long, bin long, at long")
    piece = placed.select("doc_id", "doc_tokens", "first", "bin", "at", F.posexplode("crcs").alias("i", "ids_crc32")).withColumn("start", F.col("i").cast("long") * sequence)
    length = F.least(F.lit(sequence), F.col("doc_tokens") - F.col("start"))
    full = length == sequence
    return piece.select(
        "doc_id", "start", length.alias("length"), "ids_crc32", "doc_tokens",
        F.when(full, F.col("first") + F.col("i")).otherwise(F.col("bin")).alias("sequence_id"), F.when(full, F.lit(0).cast("long")).otherwise(F.col("at")).alias("offset"),
    )


def op5_pack_ffd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
