"""One-permutation MinHash fingerprints, in DataFrame functions only.

Each distinct 5-word shingle of a text is hashed once.  The hash picks one of
``BINS`` bins and its least hash stays there.  An empty bin borrows from a
filled one by optimal densification: every empty bin visits the bins in its own
fixed random order and takes the first filled one it meets, which is the filled
bin with the least hash of (empty bin, filled bin).  Each bin keeps its low
``BITS`` bits, packed as two hex digits.  Two unrelated bins agree by chance
with probability 2^-BITS, so the share of equal bins E estimates the
resemblance as (E - 2^-BITS) / (1 - 2^-BITS), at least 0.

Edge cases: a null text is empty; a text of fewer than five words has its whole
sequence as one shingle; a text without words has the empty string as its
fingerprint, alike (1.0) only to another such.  Repeated rows get equal rows.
In ``edited`` documents follow each other by descending doc_id, nulls last,
equal ids by text; a single document follows itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionbars.llm.common import texts_of

BINS = 128
BITS = 8
SHINGLE = 5
#: Documents of a stretch of neighbouring ids, and how many stretches at most.
STRETCH_ROWS = 64
MAX_STRETCHES = 100_000
_WORD_GAP = r"[\x20\x09-\x0D]+"


def shingle_hashes(text: Column, k: int = SHINGLE) -> Column:
    """Array of the hashes of a text's shingles."""
    words = F.filter(F.split(F.lower(text), _WORD_GAP), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def roll(h: Column) -> Column:
        n = F.size(h)
        rolled = F.transform(F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)]))
        return F.when(n >= k, rolled).when(n == 0, F.array().cast("array<long>")).otherwise(F.array(F.xxhash64(h)))

    return _let(hashes, roll)


def _let(value: Column, use) -> Column:
    """Evaluate ``value`` once for an expression that mentions it often."""
    return F.get(F.transform(F.array(value), use), 0)


def bins_of(hashes: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """Array of the ``bins`` low-order parts, or an empty array without shingles."""
    shift = 64 - (bins.bit_length() - 1)

    def bin_of(h: Column) -> Column:
        return F.shiftrightunsigned(h, shift).cast("int")

    def densify(least: Column) -> Column:
        # least: sorted hashes, the first of each filled bin (sorted as signed, so bins come grouped)
        filled = F.transform(least, bin_of)

        def part(j: Column) -> Column:
            own = F.array_position(filled, j).cast("int")
            # (rank with the low bits replaced by the position): its least names the bin
            chosen = F.array_min(F.transform(filled, lambda b, at: F.xxhash64(j, b).bitwiseAND(F.lit(-bins)).bitwiseOR(at.cast("long"))))
            at = F.when(own > 0, own - 1).otherwise(chosen.bitwiseAND(F.lit(bins - 1)).cast("int"))
            return F.get(least, at).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")

        js = F.sequence(F.lit(0), F.lit(bins - 1))
        full = F.transform(least, lambda h: h.bitwiseAND(F.lit((1 << bits) - 1)).cast("int"))
        ordered = F.concat(F.slice(full, bins // 2 + 1, bins // 2), F.slice(full, 1, bins // 2))
        return F.when(F.size(least) == 0, F.array().cast("array<int>")).when(F.size(least) == bins, ordered).otherwise(F.transform(js, part))

    def firsts(s: Column) -> Column:
        return F.filter(s, lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get(s, i - 1))))

    return _let(_let(F.sort_array(hashes), firsts), densify)


def as_text(parts: Column) -> Column:
    return F.concat_ws("", F.transform(parts, lambda v: F.lpad(F.lower(F.hex(v)), 2, "0")))


def likeness(a: Column, b: Column, bits: int = BITS) -> Column:
    """Bias-corrected resemblance of two arrays of low-order parts."""
    c = 2.0**-bits
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, v: s + v)
    est = F.greatest(F.lit(0.0), (equal / F.size(a) - c) / (1.0 - c))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double")).otherwise(est)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint of every whole text."""
    docs = texts_of(docs, id_col, text_col)
    return docs.select("doc_id", as_text(bins_of(shingle_hashes(F.coalesce("text", F.lit(""))))).alias("fingerprint"))


def with_next(docs: DataFrame) -> DataFrame:
    """Adds parts (see ``bins_of``) of each text, and next_text and next_parts:
    those of the next row by descending doc_id, the first row's after the last.

    Ids are cut into stretches of equal width.  The first rows of a stretch are
    also dealt to the stretch before it, behind its own rows, so one window per
    stretch sees every neighbour and texts are shuffled once.  Only the list of
    stretches, at most MAX_STRETCHES rows, is ordered as a whole.
    """
    # one small row; its figures only place the cuts
    lo, hi, n = docs.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1))).first()
    lo, hi = (0, 0) if lo is None else (lo, hi)
    stretches = max(1, min(MAX_STRETCHES, n // STRETCH_ROWS))
    width = max(1, -(-(hi - lo + 1) // stretches))
    at = F.coalesce(F.floor((F.col("doc_id").cast("decimal(20,0)") - F.lit(lo)) / F.lit(width)).cast("long"), F.lit(-1))
    docs = docs.withColumn("_stretch", at)
    every = Window.orderBy(F.desc("_stretch"))
    heads = (docs.groupBy("_stretch").agg(F.max("doc_id").alias("_head"))
             .withColumn("_last", F.min("_stretch").over(Window.partitionBy()))
             .withColumn("_before", F.coalesce(F.lag("_stretch").over(every), F.col("_last")))
             .select(F.col("_stretch").alias("_of"), "_head", "_before"))
    ghosts = (docs.join(F.broadcast(heads), (F.col("_stretch") == F.col("_of")) & F.col("doc_id").eqNullSafe(F.col("_head")))
              .select("doc_id", "text", F.col("_before").alias("_stretch"), F.lit(1).alias("_ghost")))
    rows = docs.select("doc_id", "text", "_stretch", F.lit(0).alias("_ghost")).unionByName(ghosts)
    rows = rows.withColumn("parts", bins_of(shingle_hashes(F.col("text"))))
    w = Window.partitionBy("_stretch").orderBy("_ghost", F.desc_nulls_last("doc_id"), "text")
    return (rows.withColumns({"next_text": F.lead("text").over(w), "next_parts": F.lead("parts").over(w)})
            .filter("_ghost = 0").drop("_ghost", "_stretch"))


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text: the last third of
    its code points replaced by as many first ones of the next document."""
    docs = texts_of(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    rows = with_next(docs)
    n = F.length("text")
    new = F.concat(F.expr("substring(text, 1, length(text) - int(floor(length(text) / 3)))"), F.expr("substring(next_text, 1, int(floor(length(text) / 3)))"))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), new.alias("_new"), "parts", "next_parts")
    rows = rows.withColumn("_edited", bins_of(shingle_hashes(F.col("_new"))))
    return rows.select("doc_id", "n_chars", F.sha2(F.col("_new").cast("binary"), 256).alias("edited_sha256"), as_text(F.col("parts")).alias("fingerprint"),
                       as_text(F.col("_edited")).alias("edited_fingerprint"), likeness(F.col("parts"), F.col("_edited")).alias("near_edited"), likeness(F.col("parts"), F.col("next_parts")).alias("near_next"))
