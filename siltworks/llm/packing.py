"""Best-fit-decreasing packing of token sequences."""

from __future__ import annotations

import os
import sys
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from types import ModuleType

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.llm.common import stage, text_of

#: A tokenizer's worker keeps the ids of at most so many different chunks of a text.
CACHE = 800_000
#: The plan is broadcast up to so many rows (of 48 bytes); beyond, it is joined by a shuffle.
PLAN_ROWS = 200_000
RANK_BLOCK = 1 << 16


class SegmentTree:
    """For each remaining capacity the ranges of open bins that have it; finds the tightest that fits in logarithmic time."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.size)
        self.bins: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def push(self, room: int, first: int, count: int) -> None:
        if count and room:
            self.bins[room].append((first, count))
            self._mark(room, True)

    def pop(self, room: int) -> tuple[int, int]:
        found = self.bins[room].pop()
        if not self.bins[room]:
            self._mark(room, False)
        return found

    def _mark(self, room: int, value: bool) -> None:
        k = room + self.size
        self.open[k] = value
        while k > 1:
            k //= 2
            self.open[k] = self.open[2 * k] or self.open[2 * k + 1]

    def tightest(self, need: int) -> int | None:
        """The least room >= need that an open bin has."""
        k = need + self.size
        if self.open[k]:
            return need
        while k > 1:
            if k % 2 == 0 and self.open[k + 1]:
                k += 1
                while k < self.size:
                    k = 2 * k if self.open[2 * k] else 2 * k + 1
                return k - self.size
            k //= 2
        return None


def best_fit_plan(histogram: Iterable[tuple[int, int]], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over (length, count) pairs, each 1 <= length <= capacity.

    Gives runs (length, first rank, end rank, first bin, pieces a bin, offset):
    the pieces of that length with these ranks fill consecutive bins. Pieces of equal
    length are interchangeable, and the tightest bin of room r >= length takes
    r // length of them in turn, so a run stands for what the piece-by-piece method does.
    """
    tree, runs, bins = SegmentTree(capacity), [], 0
    for length, left in sorted(histogram, reverse=True):
        rank = 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room = capacity
                count = -(-left // (room // length))
                first, bins = bins, bins + count
            else:
                first, count = tree.pop(room)
            each = room // length
            full = min(count, left // each)
            if full:
                runs.append((length, rank, rank + full * each, first, each, capacity - room))
                tree.push(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if full < count:
                if left:  # fewer than a bin takes
                    runs.append((length, rank, rank + left, first + full, left, capacity - room))
                    tree.push(room - left * length, first + full, 1)
                    left, full = 0, full + 1
                tree.push(room, first + full, count - full)
    return runs


def chunk_encoder(tokenizer_file: str):
    """A function from chunks of text without blanks to their ids, as little-endian unsigned 32-bit bytes.

    The tokenizer's BPE is run as byte ranks: a word's last byte gets an end
    mark, and the first merges join the two. That equals the list of merges here, since each
    merge makes another token (checked when loading) and the tests compare whole texts. Chunks with anything
    but plain characters below U+0300, and other kinds of tokenizers, go through the tokenizer itself.
    """
    import json

    import numpy as np
    import regex
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_file)
    slow = lambda parts: [np.array(e.ids, "<u4").tobytes() for e in whole.encode_batch_fast(parts, add_special_tokens=False)]
    with open(tokenizer_file, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec["pre_tokenizer"].get("pretokenizers", [{}])[0]
    lowers = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
    if model.get("end_of_word_suffix") != "</w>" or not lowers or not split.get("invert") or "Regex" not in split["pattern"]:
        return slow
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}
    end = b"\xff"  # not a byte of UTF-8

    def raw(token: str) -> bytes:
        body = token.removesuffix("</w>")
        return bytes(map(byte.__getitem__, body)) + end * (body != token)

    ranks = {bytes([b]): b for b in range(256)} | {bytes([b]) + end: 256 + b for b in range(255)}
    for m in model["merges"]:
        left, right = m if isinstance(m, list) else m.split(" ")
        ranks[raw(left) + raw(right)] = 256 + len(ranks)
    if len(ranks) != 511 + len(model["merges"]):
        return slow
    ids = np.zeros(256 + len(ranks), "<u4")
    special = {t["content"] for t in spec["added_tokens"]}
    for token, k in model["vocab"].items():
        if token not in special and raw(token) in ranks:
            ids[ranks[raw(token)]] = k
    bpe = tiktoken.Encoding("ranks", pat_str="[^\\n]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
    pieces, plain = regex.compile(split["pattern"]["Regex"]).findall, regex.compile("[!-~\u00a1-\u02ff]+").fullmatch

    def encode(parts: list[str]) -> list[bytes]:
        found, rest = {}, []
        for p in parts:
            low = p.lower()
            if not plain(low) or "<|" in low:
                rest.append(p)
            elif low.isalpha():
                found[p] = ids[bpe(low.encode() + end)].tobytes()
            else:
                found[p] = ids[[r for w in pieces(low) for r in bpe(w.encode() + end)]].tobytes()
        found.update(zip(rest, slow(rest), strict=True))
        return [found[p] for p in parts]

    return encode


def _worker_cache(key: str, make):
    """What a worker process keeps from task to task."""
    held = sys.modules.setdefault("siltworks_worker", ModuleType("siltworks_worker")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def _pieces(tokenizer_file: str, capacity: int, end_id: int, keep_ids: bool):
    def run(batches) -> Iterator:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import numpy as np
        import pyarrow as pa

        encode = _worker_cache(f"encoder {tokenizer_file}", lambda: chunk_encoder(tokenizer_file))
        known = _worker_cache(f"chunks {tokenizer_file}", lambda: {"": b""})
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            at, piece, start, length, crc, kept = [], [], [], [], [], []
            for row, text in enumerate(texts):
                # No token spans a blank or a line end, so chunks between them are encoded once each.
                parts = text.as_py().replace("\n", " ").split(" ")
                try:
                    tokens = b"".join(map(known.__getitem__, parts)) + end
                except KeyError:
                    if len(known) > CACHE:
                        known.clear()
                        known[""] = b""
                    new = [p for p in {*parts} if p not in known]
                    known.update(zip(new, encode(new), strict=True))
                    tokens = b"".join(map(known.__getitem__, parts)) + end
                for k, b in enumerate(range(0, len(tokens), 4 * capacity)):
                    cut = tokens[b : b + 4 * capacity]
                    at.append(row)
                    piece.append(k)
                    start.append(b // 4)
                    length.append(len(cut) // 4)
                    crc.append(zlib.crc32(cut))
                    if keep_ids:
                        kept.append(cut)
            columns = [ids.take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(kept, pa.binary())] if keep_ids else []), names=names + ["ids"] * keep_ids)

    return run


def token_pieces(df: DataFrame, tokenizer_file: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Token pieces of whole texts: doc_id, piece, start, length, ids_crc32 (and ids, little-endian unsigned 32-bit, on demand).

    A text's ids are followed by end_id; only what is longer than capacity is
    cut. Null and empty texts give one piece of end_id alone; an empty table none;
    repeated rows give their pieces again. Other columns are not read.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    fields = [T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32"))]
    return rows.mapInArrow(_pieces(tokenizer_file, capacity, end_id, keep_ids), T.StructType(fields + [T.StructField("ids", T.BinaryType())] * keep_ids))


def pack(pieces: DataFrame, capacity: int = 2048, length_col: str = "length", order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """pieces with sequence_id and offset: best-fit decreasing over the whole table, as one bin sequence.

    The driver gets the histogram of lengths, at most `capacity` rows at any
    input size, and plans bins for runs of equal pieces on a segment tree.
    Executors rank the pieces of a length: they are dealt into hashed buckets, counted per
    (length, bucket), and a bucket's ranks start where the smaller buckets end, so that no
    length, however common, meets in one task. A rank and the plan give the place.

    Lengths must be 1 to capacity, else the job stops with an error; null counts as invalid. Repeated rows are
    pieces of their own. An empty table gives no rows.
    """
    spark = pieces.sparkSession
    if any(c in pieces.columns for c in ("sequence_id", "offset")):
        pieces = pieces.drop("sequence_id", "offset")
    length = F.col(length_col)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    checked = F.when(length.between(1, capacity), length.cast("long")).otherwise(F.raise_error(F.lit(f"length outside 1 to {capacity}")))
    rows = stage(pieces.withColumn("__len", checked).withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int")), "pack-pieces")
    counts = stage(rows.groupBy("__len", "__bucket").count(), "pack-counts")
    histogram = [(r[0], r[1]) for r in counts.groupBy("__len").agg(F.sum("count")).collect()]  # at most `capacity` rows
    runs = best_fit_plan(histogram, capacity)
    before = Window.partitionBy("__len").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__len", "__bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("__len", "__bucket").orderBy(*order)
    ranked = rows.withColumn("__rank", F.row_number().over(inside) - 1).join(starts, ["__len", "__bucket"]).withColumn("__rank", F.col("__rank") + F.col("__base"))
    plan = spark.createDataFrame(runs, "p_len long, p_lo long, p_hi long, p_bin long, p_each long, p_offset long")
    on = (F.col("__len") == F.col("p_len")) & (F.col("__rank") >= F.col("p_lo")) & (F.col("__rank") < F.col("p_hi"))
    if len(runs) <= PLAN_ROWS:
        placed = ranked.join(F.broadcast(plan), on)
    else:
        plan = plan.withColumn("p_block", F.explode(F.sequence(F.expr(f"p_lo div {RANK_BLOCK}"), F.expr(f"(p_hi - 1) div {RANK_BLOCK}"))))
        placed = ranked.withColumn("__block", F.expr(f"__rank div {RANK_BLOCK}")).join(plan, on & (F.col("__block") == F.col("p_block")))
    k = F.col("__rank") - F.col("p_lo")
    names = [c for c in pieces.columns]
    return placed.select(*names, (F.col("p_bin") + F.floor(k / F.col("p_each"))).cast("long").alias("sequence_id"), (F.col("p_offset") + (k % F.col("p_each")) * F.col("p_len")).cast("long").alias("offset"))
