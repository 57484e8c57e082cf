"""Repeated passages: every byte covered by a long string that also starts earlier is removed; suffixes are sorted in two stages."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import stage, text_of

#: A repeated string of LENGTH bytes holds an anchor of GRAM bytes: the least hash among its grams.
LENGTH, GRAM = 100, 64
#: Of anchors with more occurrences than this, equal snippets are merged before they meet in one task; with more different snippets than this, they don't.
HOT = 20_000
#: Ids are broadcast up to so many rows (8 bytes each); beyond, they are joined by a shuffle.
IDS = 2_000_000
#: Bytes of snippets whose suffixes are sorted together, if they are not one anchor's.
BLOCK = 1_000_000


def _sorted_directly(data, starts, depth: int):
    """starts in the order of the suffixes' first depth bytes: 7 bytes at a time, and only where the ones before are equal."""
    import numpy as np

    ends = np.concatenate([data.astype(np.uint64) + np.uint64(1), np.zeros(depth + 7, np.uint64)])  # the end is lower than all bytes
    order, group, open_ = starts.copy(), np.zeros(len(starts), np.int64), np.arange(len(starts))
    for at in range(0, depth, 7):
        if not len(open_):
            break
        part = order[open_]
        key = np.zeros(len(part), np.uint64)
        for k in range(at, min(at + 7, depth)):
            key = (key << np.uint64(9)) | ends[part + k]
        rank = np.lexsort((key, group[open_]))
        part, key, own = part[rank], key[rank], group[open_][rank]
        order[open_] = part
        first = np.concatenate([[True], (own[1:] != own[:-1]) | (key[1:] != key[:-1])])
        group[open_] = np.maximum.accumulate(np.where(first, open_, 0))
        alone = first & np.concatenate([first[1:], [True]])
        open_ = open_[~alone]
    return order


def suffix_array(data, depth: int, wanted=None):
    """Suffixes of a uint8 array in the order of their first `depth` bytes, by two-stage sorting.

    Only suffixes smaller than their successors are sorted directly, by their
    first `depth` bytes. The others are induced in one scan of the buckets of first bytes, from low to
    high: one begins with r equal bytes and then a lower one, so within its bucket it is placed by (r,
    rank of the suffix after these), which is known by then; in a bucket the induced ones
    come first. Beyond the end, bytes count as lower than all. Suffixes that agree in
    `depth` bytes are neighbours, in any order. wanted: a mask of the suffixes asked for (default: all); those that
    these are induced from are sorted as well.
    """
    import numpy as np

    n = len(data)
    if not n:
        return np.empty(0, np.int64)
    # stops[i]: the first place after i with another byte (or n)
    change = np.flatnonzero(data[1:] != data[:-1]) + 1
    bounds = np.append(change, n)
    stops = bounds[np.searchsorted(bounds, np.arange(n), side="right")]
    after = np.where(stops < n, data[np.minimum(stops, n - 1)].astype(np.int16), -1)
    smaller = after > data
    wanted = np.ones(n, bool) if wanted is None else wanted.copy()
    new = np.flatnonzero(wanted)
    while len(new):
        sources = stops[new[~smaller[new]]]
        new = np.unique(sources[sources < n])
        new = new[~wanted[new]]
        wanted[new] = True
    direct = _sorted_directly(data, np.flatnonzero(smaller & wanted), depth)
    direct_of = np.split(direct, np.searchsorted(data[direct], np.arange(1, 256)))
    induced = np.flatnonzero(~smaller & wanted)
    induced = induced[np.argsort(data[induced], kind="stable")]
    induced_of = np.split(induced, np.searchsorted(data[induced], np.arange(1, 256)))
    rank = np.full(n + 1, -1, np.int64)  # the empty suffix ranks lowest
    out, placed = np.empty(len(direct) + len(induced), np.int64), 0
    for low, own in zip(induced_of, direct_of, strict=True):
        low = low[np.lexsort((rank[stops[low]], stops[low] - low))]
        for part in (low, own):
            out[placed : placed + len(part)] = part
            rank[part] = np.arange(placed, placed + len(part))
            placed += len(part)
    return out


def same_as_next(data, order, depth: int):
    """For neighbours in a suffix array whether their common prefix has at least `depth` bytes (both must have as many)."""
    import numpy as np

    windows = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(depth, np.uint8)]), depth)
    out = np.zeros(len(order), bool)
    for k in range(0, len(order) - 1, 50_000):
        a, b = order[k : k + 50_000], order[k + 1 : k + 50_001]
        a = a[: len(b)]
        out[k : k + len(a)] = (windows[a] == windows[b]).all(axis=1) & (a + depth <= len(data)) & (b + depth <= len(data))
    return out


def gram_hashes(data):
    """64-bit hashes of all runs of GRAM bytes, by doubling."""
    import numpy as np

    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    width, odd = 1, 0xBF58476D1CE4E5B9
    while width < GRAM:
        h = h[:-width] * np.uint64(odd) + h[width:]
        h ^= h >> np.uint64(31)
        odd = odd * odd % 2**64 | 1
        width *= 2
    return h * np.uint64(0x94D049BB133111EB)


def _sliding(x, width: int, of):
    """of (minimum or maximum) of every `width` neighbours."""
    size, total = 1, len(x) - width + 1
    while 2 * size <= width:
        x = of(x[:-size], x[size:])
        size *= 2
    return of(x[:total], x[width - size : width - size + total])


def anchors(data):
    """(positions, hashes): for each string of LENGTH bytes the first of its grams of least hash. Equal strings have equal anchors."""
    import numpy as np

    if len(data) < LENGTH:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = gram_hashes(data)
    key = (h & np.uint64(0xFFFFFFFF80000000)) | np.arange(len(h), dtype=np.uint64)  # texts are below 2 GB
    width = LENGTH - GRAM + 1
    least = _sliding(key, width, np.minimum)
    at = np.unique(least) & np.uint64(0x7FFFFFFF)
    at = np.sort(at.astype(np.int64))
    return at, h[at]


def _anchor_rows(batches) -> Iterator:
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        held, size = [], 0
        for k, text in enumerate(batch.column(1)):
            at, h = anchors(np.frombuffer(text.as_buffer(), np.uint8)) if len(text.as_buffer() or b"") else ((), ())
            if len(at):
                held.append((np.repeat(ids[k], len(at)), at, h.view(np.int64)))
                size += len(at)
            if held and (size > 200_000 or k == len(ids) - 1):
                cols = [np.concatenate(c) for c in zip(*held, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(cols[2]), pa.array(cols[0]), pa.array(cols[1].astype(np.int32))], names=["hash", "doc_id", "pos"])
                held, size = [], 0
        if held:
            cols = [np.concatenate(c) for c in zip(*held, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(cols[2]), pa.array(cols[0]), pa.array(cols[1].astype(np.int32))], names=["hash", "doc_id", "pos"])


def _snippets(batches) -> Iterator:
    """For each anchor the bytes that a string of LENGTH bytes around it can hold, and how many of them stand before it."""
    import numpy as np
    import pyarrow as pa

    reach, names = LENGTH - GRAM, ["hash", "doc_id", "pos", "before", "bytes"]
    for batch in batches:
        places = batch.column(2)
        fields, rows = places.flatten(), np.repeat(np.arange(len(batch)), places.value_lengths().to_numpy(zero_copy_only=False))
        hashes, pos = (fields.field(k).to_numpy(zero_copy_only=False) for k in ("hash", "pos"))
        texts = batch.column(1).cast(pa.large_binary())
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2], np.uint8)
        docs = batch.column(0).to_numpy(zero_copy_only=False)
        for k in range(0, len(rows), 20_000):
            row, at, h = (x[k : k + 20_000] for x in (rows, pos, hashes))
            before = np.minimum(at, reach)
            size = np.minimum(ends[row + 1] - ends[row], at + LENGTH) - at + before
            offsets = np.concatenate([[0], np.cumsum(size)])
            source = np.repeat(ends[row] + at - before - offsets[:-1], size) + np.arange(offsets[-1])
            body = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[source])])
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(docs[row]), pa.array(at.astype(np.int32)), pa.array(before.astype(np.int32)), body], names=names)


def _group_repeats(batches) -> Iterator:
    """(doc_id, lo, hi): starts of strings that start earlier too, from snippets sorted by (hash, before, bytes, doc_id, pos)."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    result: list[tuple] = []  # arrays of doc_id, lo, hi
    block: list[tuple[bytes, int, int]] = []  # different snippets of one anchor, with their first occurrence
    held = 0

    def sort_block():
        nonlocal held
        if not block:
            return
        data = np.frombuffer(b"\n".join(b for b, _, _ in block), np.uint8)
        sizes = np.array([len(b) for b, _, _ in block])
        begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        valid = np.zeros(len(data), bool)
        for b, s in zip(begins.tolist(), sizes.tolist(), strict=True):
            valid[b : b + max(0, s - LENGTH + 1)] = True
        order = suffix_array(data, LENGTH, valid)
        order = order[valid[order]]
        equal = same_as_next(data, order, LENGTH)
        run = np.concatenate([[0], np.cumsum(~equal[:-1])]) if len(order) else np.empty(0, int)
        several = np.concatenate([equal[:-1], [False]]) | np.concatenate([[False], equal[:-1]]) if len(order) else equal
        order, run = order[several], run[several]
        owner = np.searchsorted(begins, order, side="right") - 1
        docs, starts = np.array([d for _, d, _ in block])[owner], np.array([f for _, _, f in block])[owner] + order - begins[owner]
        rank = np.lexsort((starts, docs, run))
        run, docs, starts = run[rank], docs[rank], starts[rank]
        same = np.concatenate([[False], run[1:] == run[:-1]])
        # the earliest of a run stays; it may have been seen under another anchor, as the same place
        head = np.maximum.accumulate(np.where(~same, np.arange(len(run)), 0)) if len(run) else np.empty(0, int)
        later = same & ((docs != docs[head]) | (starts != starts[head]))
        docs, starts = docs[later], starts[later]
        rank = np.lexsort((starts, docs))
        docs, starts = docs[rank], starts[rank]
        if len(docs):
            new = np.concatenate([[True], (docs[1:] != docs[:-1]) | (starts[1:] > starts[:-1] + 1)])
            ends = np.append(np.flatnonzero(new)[1:] - 1, len(docs) - 1)
            result.append((docs[new], starts[new], starts[ends]))
        block.clear()
        held = 0

    def close(rows):
        """The different snippets of an anchor meet in the suffix array."""
        nonlocal held
        if len(rows) > 1:
            if held > BLOCK:
                sort_block()
            block.extend(rows)
            held += sum(len(data) for data, _, _ in rows)

    def flush():
        cols = [np.concatenate(c) for c in zip(*result, strict=True)] if result else [np.empty(0, np.int64)] * 3
        result.clear()
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=["doc_id", "lo", "hi"])

    last, anchor, rows = None, None, []
    for batch in batches:
        if not len(batch):
            continue
        hashes, docs, pos, before = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
        texts = batch.column(4)
        first, sizes = pos.astype(np.int64) - before, pc.binary_length(texts).to_numpy(zero_copy_only=False)
        # a snippet equal to the one before it: all its strings start earlier, too
        equal = np.zeros(len(batch), bool)
        equal[0] = last == (hashes[0], before[0], texts[0].as_py())
        equal[1:] = (hashes[1:] == hashes[:-1]) & (before[1:] == before[:-1]) & pc.equal(texts[1:], texts[:-1]).to_numpy(zero_copy_only=False)
        last = hashes[-1], before[-1], texts[-1].as_py()
        whole = equal & (sizes >= LENGTH)
        result.append((docs[whole], first[whole], first[whole] + sizes[whole] - LENGTH))
        # the others are the different snippets of their anchors, each at its earliest place
        own = np.flatnonzero(~equal)
        if len(own):
            edges = [0, *(np.flatnonzero(hashes[own[1:]] != hashes[own[:-1]]) + 1).tolist(), len(own)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == 0 and hashes[own[0]] == anchor or b - a > 1 or b == len(own):
                    part = own[a:b]
                    found = list(zip(texts.take(pa.array(part)).to_pylist(), docs[part].tolist(), first[part].tolist(), strict=True))
                    if hashes[part[0]] != anchor:
                        close(rows)
                        anchor, rows = hashes[part[0]], []
                    rows += found
        if sum(len(d) for d, _, _ in result) > 50_000:
            yield flush()
    close(rows)
    sort_block()
    yield flush()


def _windows(batches) -> Iterator:
    """(string, doc_id, start) of every string of LENGTH bytes around a hot anchor."""
    import pyarrow as pa

    for batch in batches:
        docs, starts, strings = [], [], []
        for _, doc, pos, before, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for k in range(len(data) - LENGTH + 1):
                docs.append(doc)
                starts.append(pos - before + k)
                strings.append(data[k : k + LENGTH])
        yield pa.RecordBatch.from_arrays([pa.array(strings, pa.binary()), pa.array(docs, pa.int64()), pa.array(starts, pa.int64())], names=["string", "doc_id", "start"])


def _cut(batches) -> Iterator:
    """Removes the bytes that repeated strings cover, given the intervals of their starts."""
    import hashlib

    import pyarrow as pa

    for batch in batches:
        removed, spans, sha, kept_texts = [], [], [], []
        for text, starts in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
            data = text.as_buffer().to_pybytes()
            runs: list[list[int]] = []
            for lo, hi in sorted((x["lo"], x["hi"] + LENGTH) for x in starts):
                if runs and lo <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], hi)
                else:
                    runs.append([lo, hi])
            at, kept = 0, []
            for lo, hi in runs:
                kept.append(data[at:lo])
                at = hi
            kept.append(data[at:])
            left = b"".join(kept)
            removed.append(len(data) - len(left))
            spans.append(len(runs))
            sha.append(hashlib.sha256(left).hexdigest())
            kept_texts.append(left)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string()), pa.array(kept_texts, pa.binary())], names=["doc_id", "n_removed", "n_spans", "kept_sha256", "kept"])


def _semi(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Rows with (left_semi) or without (left_anti) an id of ids; ids are staged, and broadcast only if they are few."""
    return rows.join(F.broadcast(ids) if ids.count() <= IDS else ids, "doc_id", how)


def repeated_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, keep_bytes: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the bytes that stay): one row per input row.

    A byte goes if a string of LENGTH bytes that covers it also starts earlier: in
    a document of smaller id, or in the same one before. Strings are judged on the whole input.

    1. A document equal to one of smaller id is such a string throughout; it needs no search.
    2. Equal strings have equal anchors, so only anchors that occur twice can hold a repeat. Their counts are joined to their places.
    3. Of the texts around these places, different ones are sorted by their suffixes in two stages; neighbours with
       LENGTH common bytes are repeats, of which the earliest stays. Of an anchor with more than `hot` places
       only the different snippets are sorted, each standing for its equals; if these are more than `hot`, too, their strings are grouped whole.
    4. The intervals of starts are merged per document.

    Ids must be integers. Null text is empty; texts below LENGTH bytes and rows without id lose nothing.
    Rows that repeat an id count as one document's: equal texts among them both stay. Other columns are not read.
    """
    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    base = stage(texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")), "passages-base")
    first = base.where("doc_id IS NOT NULL").groupBy("sha").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    first = stage(first, "passages-first")  # so that the join below has no aggregation in its stage, and a large group of copies can be split
    copies = stage(base.join(first, "sha").where(f"doc_id > first AND n_bytes >= {LENGTH}").select("doc_id", "sha"), "passages-copies")
    single = _semi(texts.where(F.col("doc_id").isNotNull()), copies.select("doc_id").distinct(), "left_anti")
    found = single.mapInArrow(_anchor_rows, "hash long, doc_id long, pos int")
    twice = stage(found.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1"), "passages-twice")
    places = found.join(twice, "hash").groupBy("doc_id").agg(F.collect_list(F.struct("hash", "pos", "n")).alias("places"))
    places = stage(places, "passages-places")
    fields, repeats = "hash long, doc_id long, pos int, before int, bytes binary", "doc_id long, lo long, hi long"

    def around(keep):
        own = places.select("doc_id", F.filter("places", keep).alias("p")).where("size(p) > 0")
        chosen = _semi(texts, stage(own.select("doc_id").distinct(), "passages-chosen"), "left_semi")  # only their texts travel
        return chosen.join(own, "doc_id").select("doc_id", "text", "p").mapInArrow(_snippets, fields)

    groups, more = around(lambda x: x["n"] <= hot), []
    if places.where(F.exists("places", lambda x: x["n"] > hot)).limit(1).count():
        # of equal snippets the earliest stands for all; the strings of the others are later ones throughout
        firsts = around(lambda x: x["n"] > hot).groupBy("hash", "before", "bytes").agg(F.min(F.struct("doc_id", "pos")).alias("m"))
        firsts = stage(firsts.select("hash", "m.doc_id", "m.pos", "before", "bytes"), "passages-firsts")
        at = places.select("doc_id", F.explode(F.filter("places", lambda x: x["n"] > hot)).alias("p")).select("doc_id", "p.pos")
        at = at.join(base.select("doc_id", F.col("n_bytes").alias("size")), "doc_id")
        lo, hi = F.greatest(F.lit(0), F.col("pos") - (LENGTH - GRAM)), F.least(F.col("pos").cast("long"), F.col("size") - LENGTH)
        more.append(at.join(firsts.select("doc_id", "pos"), ["doc_id", "pos"], "left_anti").where(lo <= hi).select("doc_id", lo.cast("long").alias("lo"), hi.cast("long").alias("hi")))
        crowds = firsts.groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("hash")
        crowds = stage(crowds, "passages-crowds")
        groups = groups.unionByName(firsts.join(crowds, "hash", "left_anti"))
        if crowds.limit(1).count():
            # different snippets without end around one anchor: a partial minimum by whole string finds the earliest places, all others are later ones
            own = firsts.join(crowds, "hash", "left_semi")
            earliest = own.mapInArrow(_windows, "string binary, doc_id long, start long").groupBy("string").agg(F.min(F.struct("doc_id", "start")).alias("m"))
            every = own.mapInArrow(_windows, "string binary, doc_id long, start long").select("doc_id", "start").distinct()
            later = every.join(earliest.select("m.*").distinct(), ["doc_id", "start"], "left_anti")
            more.append(later.select("doc_id", F.col("start").alias("lo"), F.col("start").alias("hi")))
    starts = groups.repartition("hash").sortWithinPartitions("hash", "before", "bytes", "doc_id", "pos").mapInArrow(_group_repeats, repeats)
    starts = stage(starts, "passages-starts")
    for part in more:
        starts = starts.unionByName(part)
    spans = stage(starts.groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi")).alias("starts")), "passages-spans")
    cut = _semi(texts, spans.select("doc_id"), "left_semi").join(spans, "doc_id").select("doc_id", "text", "starts").mapInArrow(_cut, "doc_id long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    cut = cut.withColumn("n_kept", F.octet_length("kept")) if keep_bytes else cut.drop("kept")
    gone = base.join(copies.distinct(), ["doc_id", "sha"], "left_semi")
    empty = F.lit(b"")
    whole = base.join(copies.distinct(), ["doc_id", "sha"], "left_anti")
    rest = whole.join(spans.select("doc_id"), "doc_id", "left_anti")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * keep_bytes
    gone = gone.select("doc_id", "n_bytes", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.sha2(empty, 256).alias("kept_sha256"), *[empty.alias("kept")] * keep_bytes)
    if keep_bytes:
        rest = texts.where("doc_id IS NULL").select("doc_id", "text").unionByName(_semi(_semi(texts, spans.select("doc_id"), "left_anti"), copies.select("doc_id").distinct(), "left_anti").where("doc_id IS NOT NULL"))
        rest = rest.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"), F.encode("text", "UTF-8").alias("kept"))
    else:
        rest = rest.select("doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("sha").alias("kept_sha256"))
    cut = cut.withColumn("n_bytes", F.col("n_removed") + F.col("n_kept")).select(*names) if keep_bytes else cut.join(whole.select("doc_id", "n_bytes").distinct(), "doc_id").select(*names)
    return gone.unionByName(rest).unionByName(cut)
