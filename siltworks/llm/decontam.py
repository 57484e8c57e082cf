"""Benchmark decontamination by spaced-seed hashing. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import fresh, stage, text_of

#: Token positions that a seed compares; the others of its SPAN are ignored. Whatever 2 of
#: 13 tokens are substituted, the first mask fits somewhere between them.
SPAN, MASKS = 8, ((0, 1, 3, 6, 7), (0, 2, 3, 5, 7))
#: Items of SPAN to 12 tokens have no such window; any 3 equal tokens in a row find them, which a fifth of substitutions leaves.
SHORT_SPAN, SHORT_MASKS = 3, ((0, 1, 2),)
#: Items of fewer than SPAN tokens match as they are: from RUN tokens on anywhere in a text, shorter ones as a whole text.
RUN = 5
#: A leak: of WINDOW aligned tokens (a whole item, if it is shorter) at least this share is equal.
WINDOW, PERCENT = 13, 80
#: Seeds (of about 40 bytes) and found ids are broadcast up to so many rows; beyond, they are joined by a shuffle.
SEED_ROWS = 400_000
# The ranges of scripts written without blanks between words (Thai and Lao, Burmese, Khmer, kana, Han).
UNSPACED = r"฀-໿က-႟ក-៿぀-ヿ㐀-䶿一-鿿豈-﫿\x{20000}-\x{3FFFF}"
#: A token: a character of those scripts, else a run of letters and digits.
TOKEN = rf"[a-z0-9[\p{{L}}\p{{N}}&&[^{UNSPACED}]]]++|[{UNSPACED}]"


def token_hashes(text: Column) -> Column:
    """Hashes of a text's lower-cased tokens."""
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0)), lambda w: F.xxhash64(w))


def _few(df: DataFrame) -> DataFrame:
    """A staged table, broadcast only if it has few rows."""
    return F.broadcast(df) if df.count() <= SEED_ROWS else df


def _seeds(rows: DataFrame, keep: list[str], span: int, masks: tuple) -> DataFrame:
    """A row for each seed of rows(keep, hashes): keep, at (its first token), seed. The array of hashes goes no further than here."""
    starts = F.when(F.size("hashes") >= span, F.sequence(F.lit(0), F.size("hashes") - span))
    rows = rows.select(*keep, "hashes", F.explode_outer(starts).alias("at")).where("at IS NOT NULL")
    of = lambda k, mask: F.xxhash64(F.lit(k), *(F.get("hashes", F.col("at") + o) for o in mask))
    return rows.select(*keep, "at", F.explode(F.array(*(of(k, mask) for k, mask in enumerate(masks)))).alias("seed"))


def _found(texts: DataFrame, items: DataFrame, span: int, masks: tuple, window: int, percent: int) -> DataFrame:
    """(doc_id, item_id, matched) where seeds of texts meet those of items and the tokens around agree."""
    index = _few(stage(_seeds(items, ["item_id"], span, masks).select("seed", "item_id", F.col("at").alias("item_at")).distinct(), "leak-seeds"))
    hits = _seeds(texts, ["doc_id", "version"], span, masks).join(index, "seed").select("doc_id", "version", "item_id", "item_at", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    hits = stage(hits, "leak-hits")
    # the tokens of a document and of an item travel once to all hits between them
    places = hits.groupBy("doc_id", "version", "item_id").agg(F.collect_list(F.struct("item_at", "shift")).alias("places"))
    same = F.col("doc_id").eqNullSafe(F.col("own")) & (F.col("version") == F.col("own_version"))
    ids = _few(stage(hits.select(F.col("doc_id").alias("own"), F.col("version").alias("own_version")).distinct(), "leak-documents"))
    # by id alone first: that join goes below the tokens, so that only documents with hits are read into tokens again
    held = texts.join(_few(stage(hits.select(F.col("doc_id").alias("hit")).distinct(), "leak-ids")), F.col("doc_id").eqNullSafe(F.col("hit")), "left_semi")
    held = held.join(ids, same, "left_semi").select(F.col("doc_id").alias("own"), F.col("version").alias("own_version"), "hashes")
    known = items.select(F.col("item_id").alias("own_item"), F.col("hashes").alias("item"))
    both = places.join(known, F.col("item_id").eqNullSafe(F.col("own_item"))).join(held, same)
    width = F.least(F.size("item"), F.lit(window))

    def matched(place):
        # only a window that holds the seed counts: its tokens are the item's from first to last + width - 1
        first, last = F.greatest(F.lit(0), place["item_at"] + span - width), F.least(place["item_at"], F.size("item") - width)
        equal = lambda j: F.when(F.get("hashes", j + place["shift"]) == F.get("item", j), 1).otherwise(0)
        count = lambda s: F.aggregate(F.sequence(s, s + width - 1), F.lit(0), lambda a, j: a + equal(j))
        return F.array_max(F.transform(F.sequence(first, last), count))

    best = both.select("doc_id", "item_id", width.alias("width"), F.array_max(F.transform("places", matched)).alias("matched"))
    return best.where(F.col("matched") * 100 >= F.col("width") * percent).select("doc_id", "item_id", "matched")


def _exact(texts: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, matched) of items below SPAN tokens: equal runs of texts, or whole texts below RUN tokens."""
    known = items.select("item_id", F.size("hashes").alias("n"), F.xxhash64("hashes").alias("digest"), F.col("hashes").alias("item"))
    known = F.broadcast(known) if items.count() <= SEED_ROWS else known
    runs = [F.when(F.size("hashes") == n, F.array(F.struct(F.lit(n).alias("n"), F.col("hashes").alias("run")))) for n in range(1, RUN)]
    each = lambda n: F.transform(F.sequence(F.lit(1), F.size("hashes") - n + 1), lambda i: F.struct(F.lit(n).alias("n"), F.slice("hashes", i, n).alias("run")))
    runs += [F.when(F.size("hashes") >= n, each(n)) for n in range(RUN, SPAN)]
    sizes = {r[0] for r in items.select(F.size("hashes")).distinct().collect()}  # of 1 to SPAN - 1
    found = None
    for n in sorted(sizes):
        own = texts.select("doc_id", F.explode(runs[n - 1]).alias("r")).select("doc_id", "r.n", "r.run").withColumn("digest", F.xxhash64("run"))
        own = own.join(known, ["n", "digest"]).where(F.col("run") == F.col("item")).select("doc_id", "item_id", F.col("n").alias("matched"))
        found = own if found is None else found.union(own)
    return found


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, matched): the benchmark items that a document holds, matched = most equal tokens in a window.

    Seeds of all documents meet those of all items in a hash join; then the tokens around each
    hit are compared, so substituted tokens are tolerated up to the window's share. Items of fewer than SPAN tokens
    match exactly: from RUN tokens on as a run of a document's tokens, shorter ones as a whole document.
    Null and empty texts match nothing. Rows that repeat an
    id are judged as one document, and so are rows without id. Other columns are not read.
    """
    items = stage(benchmark.select(F.col(item_col).alias("item_id"), token_hashes(text_of(item_text_col)).alias("hashes")), "leak-items")
    texts = docs.select(F.col(id_col).alias("doc_id"), token_hashes(text_of(text_col)).alias("hashes")).withColumn("version", F.xxhash64("hashes"))
    found = _found(texts, items.where(F.size("hashes") >= WINDOW), SPAN, MASKS, window, percent)
    middle, short = items.where(F.size("hashes").between(SPAN, WINDOW - 1)), items.where(F.size("hashes").between(1, SPAN - 1))
    if middle.limit(1).count():
        found = found.union(_found(texts, middle, SHORT_SPAN, SHORT_MASKS, window, percent))
    if short.limit(1).count():
        found = found.union(_exact(texts, short))
    return found.groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, contaminated, n_items, item_id (the smallest item that it holds, else null)."""
    hit = leaks(docs, benchmark, id_col, text_col, **options).groupBy(F.col("doc_id").alias("own")).agg(F.count("*").alias("n_items"), F.min("item_id").alias("item_id"))
    rows = docs.select(F.col(id_col).alias("doc_id"))
    out = rows.join(hit, F.col("doc_id").eqNullSafe(F.col("own")), "left")
    return out.select("doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), "item_id")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs without the documents that hold a benchmark item; columns and texts unchanged."""
    own = fresh(docs, "id")
    hit = leaks(docs, benchmark, id_col, text_col, **options).select(F.col("doc_id").alias(own)).distinct()
    return docs.join(hit, F.col(id_col).eqNullSafe(F.col(own)), "left_anti")
