"""Near-duplicate documents: b-bit MinHash signatures joined by a multi-index Hamming join, links confirmed on full sets."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.llm.common import connected_components, fresh, stage, text_of

#: Bits of a symbol, the least symbols of a chunk (so that a masked chunk has 48 bits at least), and the chance that a pair just at the similarity is further apart than the distance.
BITS, LEAST, MISS = 16, 4, 1e-6
#: A cell of the last step holds about so many rows of each side, and about so many shingles of one.
CELL, CELL_SHINGLES = 500, 2_000_000
#: Members of a star that meet one copy of its middle's set, and rows (of 16 bytes) up to which a table is broadcast.
SALT_ROWS, ROWS = 2_000, 2_000_000
#: Bytes of text that a worker hashes at a time.
SEGMENT = 2_000_000


@dataclass(frozen=True)
class Scheme:
    """symbols of a signature; distance: signatures of a pair differ in more of them with a chance below MISS; chunks: so many that one of them has one error at most."""

    percent: int
    shingle: int
    symbols: int
    distance: int
    chunks: int


def within(percent: int, symbols: int) -> int:
    """The distance that a pair just at the similarity exceeds with a chance below MISS."""
    p, tail, d = 1 - percent / 100, 1.0, -1
    while tail > MISS:
        d += 1
        tail -= math.comb(symbols, d) * p**d * (1 - p) ** (symbols - d)
    return d


def scheme(percent: int, shingle: int) -> Scheme:
    """The fewest symbols whose chunks have LEAST symbols; 256 (narrower chunks, and so more chance buckets) where none do."""
    for symbols in range(48, 257, 16):
        d = within(percent, symbols)
        if symbols // (d // 2 + 1) >= LEAST:
            break
    return Scheme(percent, shingle, symbols, d, d // 2 + 1)


def chunk_edges(cfg: Scheme) -> list[int]:
    return [k * cfg.symbols // cfg.chunks for k in range(cfg.chunks + 1)]


def word_hashes(texts: list[str]):
    """64-bit hashes of all words of texts, and how many each text has.

    Words are `[^\\x20\\x09-\\x0D]+` of the UTF-8 bytes with A-Z lower-cased. Bytes are
    hashed in blocks of about SEGMENT, cut at blanks, so that memory doesn't follow the longest text.
    """
    import numpy as np

    blank = np.zeros(256, bool)
    blank[[9, 10, 11, 12, 13, 32]] = True
    parts, owners, block, size = [], [], [], 0
    hashes, counts = [], np.zeros(len(texts), np.int64)

    def flush():
        nonlocal block, owners, size
        if not block:
            return
        data = np.frombuffer(b" ".join([b"", *block, b""]), np.uint8)
        ends = np.cumsum([len(b) + 1 for b in block])
        gap = blank[data]
        starts = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
        if len(starts):
            stops = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
            lengths = stops - starts
            inside = data[~gap].astype(np.uint64) + np.uint64(1)
            first = np.cumsum(lengths) - lengths
            place = np.arange(len(inside)) - np.repeat(first, lengths)
            longest = int(lengths.max())
            powers = np.cumprod(np.full(longest, 0x9E3779B97F4A7C15, np.uint64))
            h = np.add.reduceat(inside * powers[place], first)
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(29)
            hashes.append(h)
            owner = np.array(owners)[np.searchsorted(ends, starts, side="left")]
            np.add.at(counts, owner, 1) if len(block) < 2 else np.copyto(counts, counts + np.bincount(owner, minlength=len(counts)))
        block, owners, size = [], [], 0

    for k, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass").lower()  # bytes.lower() changes A-Z only
        while data:
            cut = len(data)
            if cut > SEGMENT:
                cut = max(data.rfind(c, 0, SEGMENT) for c in (b" ", b"\n", b"\t", b"\x0b", b"\x0c", b"\r")) + 1
                if not cut:  # one word longer than a block
                    cut = min((x for c in (b" ", b"\n", b"\t", b"\x0b", b"\x0c", b"\r") if (x := data.find(c, SEGMENT)) >= 0), default=len(data))
            block.append(data[:cut])
            owners.append(k)
            size += cut
            data = data[cut:]
            if size > SEGMENT:
                flush()
    flush()
    return (np.concatenate(hashes) if hashes else np.empty(0, np.uint64)), counts


def shingle_sets(texts: list[str], shingle: int) -> Iterator:
    """For each text the sorted distinct 64-bit hashes of its shingles; the whole sequence as one, if it has fewer words."""
    import numpy as np

    odd = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
    words, counts = word_hashes(texts)
    at = 0
    for count in counts.tolist():
        h, at = words[at : at + count], at + count
        width = min(shingle, count)
        n = count - width + 1 if count else 0
        s = np.full(n, width, np.uint64)
        for k in range(width):
            s = (s ^ h[k : k + n]) * odd[k % 3]
            s ^= s >> np.uint64(29)
        s.sort()
        yield s[np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))] if n > 1 else s


def _slices(batch):
    """A batch's texts in lists of about SEGMENT characters, with their first row."""
    texts, held, size, first = batch.to_pylist(), [], 0, 0
    for k, t in enumerate(texts):
        held.append(t)
        size += len(t)
        if size > SEGMENT or k == len(texts) - 1:
            yield held
            held, size = [], 0


def _permutations(symbols: int):
    import numpy as np

    rng = np.random.RandomState(20)
    mul = (rng.randint(0, 2**31, 2 * symbols).astype(np.uint64) << np.uint64(32)) | (rng.randint(0, 2**31, 2 * symbols).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
    return mul[:symbols, None], mul[symbols:, None]


def _minhash(s, mul, add) -> bytes:
    """b-bit MinHash: for each permutation the top BITS bits of a mix of the least value."""
    import numpy as np

    low = np.full(len(mul), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), 512):
        low = np.minimum(low, (s[i : i + 512] * mul + add).min(axis=1))
    low ^= low >> np.uint64(31)
    return ((low * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(">u2").tobytes()


def _signatures(cfg: Scheme):
    def run(batches) -> Iterator:
        import hashlib

        import pyarrow as pa

        mul, add = _permutations(cfg.symbols)
        for batch in batches:
            count, digest, sig = [], [], []
            for texts in _slices(batch.column(1)):
                for s in shingle_sets(texts, cfg.shingle):
                    count.append(len(s))
                    digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    sig.append(_minhash(s, mul, add) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary())], names=["doc_id", "n_shingles", "digest", "sig"])

    return run


def signatures(df: DataFrame, cfg: Scheme, id_col: str, text_col: str) -> DataFrame:
    rows = df.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(_signatures(cfg), T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_shingles", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("sig", T.BinaryType())]))


def _probes(cfg: Scheme):
    """A row for each symbol of a signature: the key of its chunk without it, as one error is allowed; the low 8 bits of the key are the symbol's place."""

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        edges = np.array(chunk_edges(cfg))
        chunk = np.repeat(np.arange(cfg.chunks), np.diff(edges))
        mul, add = _permutations(cfg.symbols)
        for batch in batches:
            if not len(batch):
                continue
            rep = batch.column(0).to_numpy(zero_copy_only=False)
            part = (_matrix(batch.column(1)).astype(np.uint64) + np.uint64(1)) * mul[:, 0]
            part ^= part >> np.uint64(31)
            part *= np.uint64(0xBF58476D1CE4E5B9)
            key = np.add.reduceat(part, edges[:-1], axis=1)[:, chunk] - part + add[:, 0]
            key ^= key >> np.uint64(30)
            key *= np.uint64(0x94D049BB133111EB)
            key = (key & np.uint64(2**64 - 256)) | np.arange(cfg.symbols, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).view(np.int64)), pa.array(np.repeat(rep, cfg.symbols))], names=["key", "rep"])

    return run


def _matrix(sigs):
    """A column of signatures as an array of rows of symbols."""
    import numpy as np

    return np.frombuffer(b"".join(sigs.to_pylist()), ">u2").reshape(len(sigs), -1)


def _set_of(cfg: Scheme, carried: tuple[str, ...]):
    """The carried columns and `words`, the sorted shingle hashes of the last column's text."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(len(carried))
            sets = [s.tobytes() for held in _slices(texts) for s in shingle_sets(held, cfg.shingle)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(carried))), pa.array(sets, pa.binary())], names=[*carried, "words"])

    return run


def _similar(x, y, percent: int) -> bool:
    import numpy as np

    if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)):
        return False
    place = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = int((y[place] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _verify(percent: int):
    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            ok = [_similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _groups(batches, keys: int) -> Iterator:
    """Tables of the rows that agree in the first `keys` columns, from batches sorted by them."""
    import numpy as np
    import pyarrow as pa

    held, last = [], None
    for batch in batches:
        if not len(batch):
            continue
        cols = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)])
        edges = [0, *(np.flatnonzero((cols[:, 1:] != cols[:, :-1]).any(axis=0)) + 1).tolist(), len(batch)]
        for a, b in zip(edges, edges[1:], strict=False):
            own = cols[:, a].tolist()
            if held and own != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = own
    if held:
        yield pa.Table.from_batches(held)


def _near_pairs(cell, cfg: Scheme):
    """(held rows, other rows, near) of a cell: near[i, j] tells whether two rows of different components are under the distance. Of two apart rows only the lower id is held against the other."""
    import numpy as np

    held = cell.column("held").to_numpy() == 1
    sigs, rep, comp, apart = _matrix(cell.column("sig").combine_chunks()), cell.column("rep").to_numpy(), cell.column("component").to_numpy(), cell.column("apart").to_numpy()
    i, j = np.flatnonzero(held), np.flatnonzero(~held)
    near = np.zeros((len(i), len(j)), bool)
    for k, m in enumerate(i.tolist()):
        near[k] = ((sigs[m] != sigs[j]).sum(axis=1) <= cfg.distance) & (comp[m] != comp[j]) & (~apart[j] | (rep[m] < rep[j]))
    return i, j, near


def _partners(cfg: Scheme):
    """The rows of a cell that have a partner in it; no pair is written."""

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for cell in _groups(batches, 3):
            i, j, near = _near_pairs(cell, cfg)
            rows = np.sort(np.concatenate([i[near.any(axis=1)], j[near.any(axis=0)]]))
            yield from cell.take(pa.array(rows)).combine_chunks().to_batches()

    return run


def _settle(cfg: Scheme):
    """Links between the held rows of a cell and its others. Components joined here are joined from then on, so that of many copies each brings one link."""

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for cell in _groups(batches, 3):
            i, j, near = _near_pairs(cell, cfg)
            rep, comp = cell.column("rep").to_pylist(), cell.column("component").to_pylist()
            sets = [np.frombuffer(w.as_buffer(), np.uint64) for w in cell.column("words")]
            parent, out = {c: c for c in comp}, ([], [])

            def find(x, parent=parent):
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            for k, m in zip(*np.nonzero(near.T), strict=True):
                x, y = int(j[k]), int(i[m])
                a, b = find(comp[x]), find(comp[y])
                if a != b and _similar(sets[x], sets[y], cfg.percent):
                    out[0].append(rep[x])
                    out[1].append(rep[y])
                    parent[a] = b
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64())], names=["a", "b"])

    return run


def _longs(sig: str, n: int) -> list:
    """A signature of n bytes as long columns' expressions."""
    return [F.expr(f"cast(conv(hex(substring({sig}, {8 * k + 1}, 8)), 16, -10) as bigint)") for k in range(n // 8)]


def _wrong(x, y):
    """One set bit for each of the 4 symbols in which two longs differ (the lowest bit of its 16)."""
    d = x.bitwiseXOR(y)
    for n in (8, 4, 2, 1):
        d = d.bitwiseOR(F.shiftrightunsigned(d, n))
    return d.bitwiseAND(F.lit(0x0001000100010001))


def _few(df: DataFrame) -> DataFrame:
    """A staged table, broadcast only if it has few rows."""
    return F.broadcast(df) if df.count() <= ROWS else df


def _links(pairs: DataFrame, texts: DataFrame, cfg: Scheme) -> DataFrame:
    """The staged pairs(a, b) whose full sets have the similarity. Each a's set travels to its b; a b of more than SALT_ROWS pairs has a copy for each so many of them."""
    salts = stage(pairs.groupBy("b").agg(F.ceil(F.count("*") / SALT_ROWS).cast("int").alias("salts")), "near-leads")
    dealt = pairs.join(_few(salts), "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("salts")).cast("int").alias("salt"))
    dealt = stage(dealt, "near-dealt-pairs")
    left = texts.join(_few(dealt), texts.rep == dealt.a).select("a", "b", "salt", "text").mapInArrow(_set_of(cfg, ("a", "b", "salt")), "a long, b long, salt int, words binary")
    right = texts.join(_few(salts), texts.rep == salts.b).select("b", "salts", "text").mapInArrow(_set_of(cfg, ("b", "salts")), "b long, salts int, words binary")
    right = right.select("b", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("words").alias("y"))
    both = left.join(right, ["b", "salt"])
    return both.select("a", "b", F.col("words").alias("x"), "y").mapInArrow(_verify(cfg.percent), "a long, b long")


def near_duplicates(df: DataFrame, percent: int = 80, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per input row.

    Two documents are linked if 100 * intersection >= percent * union of their
    sets of word shingles; component_id is the smallest id that links reach.

    1. A document's set gives a signature of symbols of BITS bits. Documents with equal sets are one class.
    2. Multi-index Hamming join: signatures at most `distance` apart have, by the
       pigeonhole principle, a chunk with one error at most. Each symbol is
       masked in turn, and classes that share a masked chunk share a bucket. This finds all pairs
       under the distance; a pair just at the similarity exceeds it with a chance below MISS.
    3. Star: each class is compared, on full sets, with the nearest middle of its buckets; a bucket's middle is the
       member that shares most. A group of near copies is linked so, without a pair for any two of them.
    4. Rest: members that are not in their middle's component ("apart") must meet all other members of
       its buckets in other components. A middle's rows are dealt to a grid of cells, each of about CELL apart rows and CELL others,
       so that no task gets a large group whole. Cells first tell, by signatures, which rows have a partner under the distance (no pair is
       written); only these bring their sets, and are compared on them but for those that are connected meanwhile.

    No group is capped: what step 3 doesn't link, step 4 settles. Null and empty texts have an
    empty set, and are linked with nothing. Ids must be integers; rows that repeat an id are one
    document, and a row without id is linked with nothing, has component_id null and is kept. Other columns are not read.
    """
    cfg = scheme(percent, shingle)
    width = cfg.symbols * BITS // 8
    names = [f"s{k}" for k in range(width // 8)]
    sig = stage(signatures(df, cfg, id_col, text_col), "near-signatures")
    classes = sig.where("doc_id IS NOT NULL AND digest IS NOT NULL").groupBy("digest").agg(F.min(F.struct("doc_id", "n_shingles", "sig")).alias("m"))
    reps = stage(classes.select("digest", F.col("m.doc_id").alias("rep"), F.col("m.n_shingles").alias("size"), F.col("m.sig").alias("sig")), "near-classes")
    packed = reps.select("rep", *(c.alias(n) for c, n in zip(_longs("sig", width), names, strict=True)))
    probes = reps.select("rep", "sig").mapInArrow(_probes(cfg), "key long, rep long")
    buckets = probes.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = stage(probes.join(buckets, "key"), "near-members")
    distance = sum((F.bit_count(_wrong(F.col("x" + n), F.col("y" + n))) for n in names), F.lit(0))
    sided = lambda side, name: packed.select(F.col("rep").alias(name), *(F.col(n).alias(side + n) for n in names))

    score = members.groupBy("rep").agg(F.sum("n").alias("score"))
    middle = members.join(score, "rep").groupBy("key").agg(F.max(F.struct("score", -F.col("rep"))).alias("m"))
    middle = stage(middle.select("key", (-F.col("m.col2")).alias("lead")), "near-middles")
    star = members.join(middle, "key").where("rep <> lead").select(F.col("rep").alias("a"), F.col("lead").alias("b")).distinct()
    star = star.join(sided("x", "a"), "a").join(sided("y", "b"), "b").select("a", "b", distance.alias("d")).where(F.col("d") <= cfg.distance)
    nearest = stage(star.groupBy("a").agg(F.min(F.struct("d", "b")).alias("m")).select("a", F.col("m.b").alias("b")), "near-star")

    texts = df.select(F.col(id_col).alias("rep"), text_of(text_col).alias("text"))
    linked = stage(_links(nearest, texts, cfg), "near-links")
    component = connected_components(linked, "near-first")

    at = members.join(component.withColumnRenamed("id", "rep"), "rep", "left").select("key", "rep", F.coalesce("component", "rep").alias("component"))
    open_keys = at.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
    lead_at = middle.join(open_keys, "key").join(component, middle.lead == component.id, "left").select("key", "lead", F.coalesce("component", "lead").alias("lead_component"))
    rest = at.join(lead_at, "key").select("lead", "rep", "component", (F.col("component") != F.col("lead_component")).alias("apart")).distinct()
    rest = stage(rest.join(reps.select("rep", "size"), "rep"), "near-rest")
    held = F.ceil(F.count_if("apart") / CELL + F.sum(F.when(F.col("apart"), F.col("size")).otherwise(0)) / CELL_SHINGLES).cast("int")
    grid = rest.groupBy("lead").agg(held.alias("held_blocks"), F.ceil(F.count("*") / CELL).cast("int").alias("blocks")).where("held_blocks > 0")
    placed = rest.drop("size").join(_few(stage(grid, "near-grid")), "lead")
    own = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "rep"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = placed.where("apart").withColumn("i", own(1, "held_blocks")).withColumn("j", every("blocks")).withColumn("held", F.lit(1))
    dealt = dealt.unionByName(placed.withColumn("j", own(2, "blocks")).withColumn("i", every("held_blocks")).withColumn("held", F.lit(0)))
    dealt = dealt.join(reps.select("rep", "sig"), "rep").select("lead", "i", "j", "held", "rep", "component", "apart", "sig")
    cells = lambda rows: rows.repartition("lead", "i", "j").sortWithinPartitions("lead", "i", "j")
    left = stage(cells(dealt).mapInArrow(_partners(cfg), dealt.schema), "near-left")
    sets = texts.join(_few(stage(left.select("rep").distinct(), "near-left-ids")), "rep").mapInArrow(_set_of(cfg, ("rep",)), "rep long, words binary")
    more = cells(left.join(sets, "rep").select("lead", "i", "j", "held", "rep", "component", "apart", "sig", "words")).mapInArrow(_settle(cfg), "a long, b long")
    component = connected_components(linked.union(stage(more, "near-more")), "near-all")

    out = sig.join(reps.select("digest", "rep"), "digest", "left").join(component, F.col("rep") == component.id, "left")
    found = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return out.select("doc_id", "n_shingles", found.alias("component_id"), F.col("doc_id").eqNullSafe(found).alias("kept"))


def drop_near_duplicates(df: DataFrame, percent: int = 80, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with one document of each component, that of the smallest id; columns and texts unchanged."""
    own = fresh(df, "id")
    gone = near_duplicates(df, percent, shingle, id_col, text_col).where("NOT kept").select(F.col("doc_id").alias(own)).distinct()
    return df.join(gone, F.col(id_col) == F.col(own), "left_anti")
