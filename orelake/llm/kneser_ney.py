"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The verdict rests on words (``word_grams``): counts over all trusted text, in
shards that grow with it, which estimate every gram of the documents.

A document's perplexity is taken over its whole text.  Thresholds are set in
each language on text the model has not seen: a second model leaves out the
trusted rows with crc32(doc_id) mod 5 = 0, and these and the rows labelled poor
are scored under it.  Up to the first two ``QUANTILES`` of the unseen trusted
rows a document is ``head`` or ``middle``.  It is kept up to that quantile of
``CUTS`` that sets trusted and poor rows apart most (share of trusted rows kept
less share of poor rows kept; of equals the highest), or up to the last of
``QUANTILES`` where no poor row has a perplexity; never less than that last
quantile of all trusted rows under the model that has counted them.

Trusted are rows labelled with quality 1, poor those with 0 and never 1.  A null
language is a language of its own; one without unseen trusted rows uses the
thresholds over all languages.  Null texts and texts without words have no
perplexity and are not kept.  Without trusted text every word is equally likely
and all texts are kept.  A repeated id is trusted once it is labelled so;
repeated rows are scored alike; an empty table gives an empty result; columns
other than ``doc_id``, ``text`` and ``lang`` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelake.llm import word_grams
from orelake.storage import write_out

# Quantiles of trusted perplexity: head, middle, kept.
QUANTILES = (0.3, 0.6, 0.999)
# Quantiles of trusted perplexity among which poor rows choose the bound of what is kept.
CUTS = tuple(i / 100 for i in range(50, 100)) + (0.995, 0.999)
# One in so many trusted rows sets the thresholds.
_UNSEEN = 5


def discounts(n: dict[int, int]) -> tuple[float, float, float]:
    """The three discounts of the modified form, from the counts of counts."""
    n1, n2, n3, n4 = (n.get(i, 0) for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    found = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    # Small or odd counts of counts can leave the range in which the mass is positive.
    return tuple(min(max(d, 0.05), i + 0.95) for i, d in enumerate(found))


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.filter("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()


def poor_ids(labels: DataFrame) -> DataFrame:
    known = labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("best"))
    return known.filter("best = 0").select("doc_id")


def _language() -> Column:
    """Languages as keys of joins; null is one of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))


def _points(known: DataFrame, by: list[str], quantiles: tuple[float, float, float]) -> DataFrame:
    """(by, points): the three thresholds of a group's unseen trusted rows."""
    want = [*quantiles, *CUTS]
    good = F.col("good") == 1
    at = known.groupBy(*by).agg(F.percentile_approx(F.when(good, F.col("p")), want, 10000).alias("at")).filter("at is not null")
    held = known.join(at, by) if by else known.withColumn("at", at.scalar())
    passed = [F.count_if(~good & (F.col("p") <= F.col("at")[i])).alias(f"k{i}") for i in range(3, len(want))]
    counts = held.groupBy(*by).agg(F.first("at").alias("at"), F.count_if(~good).alias("n"), *passed)
    # Trusted rows at a quantile of theirs are kept in its share; of equals the highest.
    gains = [F.struct((F.lit(want[i]) - F.col(f"k{i}") / F.col("n")).alias("gain"), F.lit(i).alias("i")) for i in range(3, len(want))]
    best = F.get("at", F.array_max(F.array(*gains)).getField("i"))
    last = F.when(F.col("n") > 0, best).otherwise(F.col("at")[2])
    return counts.filter("at is not null").select(*by, F.array(F.col("at")[0], F.col("at")[1], last).alias("points"))


def _thresholds(known: DataFrame, quantiles: tuple[float, float, float]) -> tuple[DataFrame, Column]:
    """(language, points) of the languages with unseen trusted rows, and the points over all of them."""
    whole = write_out(_points(known, [], quantiles), "kn-whole")
    return _points(known, ["language"], quantiles), F.coalesce(whole.scalar(), F.array(*[F.lit(float("inf"))] * 3))


def _marked(trusted: DataFrame, poor: DataFrame | None) -> DataFrame:
    """(doc_id, how, good): the marks of ``word_grams`` for trusted and poor rows."""
    seen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % _UNSEEN != 0
    of = F.when(seen, word_grams.TRUSTED | word_grams.SEEN).otherwise(word_grams.TRUSTED | word_grams.ASKED)
    marked = trusted.filter("doc_id is not null").select(F.col("doc_id").cast("long")).distinct().select("doc_id", of.alias("how"), F.lit(1).alias("good"))
    if poor is not None:
        others = poor.join(trusted, "doc_id", "left_anti").select(F.col("doc_id").cast("long")).distinct()
        marked = marked.unionByName(others.select("doc_id", F.lit(word_grams.ASKED).alias("how"), F.lit(0).alias("good")))
    return write_out(marked, "kn-marked")


def judge(
    docs: DataFrame, trusted: DataFrame, quantiles: tuple[float, float, float] = QUANTILES, poor: DataFrame | None = None
) -> DataFrame:
    """doc_id, lang, n_symbols, perplexity, threshold, bucket and kept of every row of ``docs``."""
    mark = F.xxhash64("text", F.isnull("text"), "lang", F.isnull("lang")).alias("mark")
    read = docs.select(F.col("doc_id").cast("long"), "lang", "text", mark)
    read = read.withColumn("rid", F.xxhash64("doc_id", F.isnull("doc_id"), "mark"))
    marked = _marked(trusted, poor)
    # Texts stay where they are: what is labelled goes to them.
    asked = read.join(F.broadcast(marked), "doc_id", "left").select("rid", F.coalesce("how", F.lit(0)).alias("mark"), "text")
    tokens = word_grams.words(asked, "rid", "mark")
    counted = read.join(F.broadcast(marked.filter(F.col("how") % 2 == 1)), "doc_id").select("rid", F.col("how").alias("mark"), "text")
    sums = word_grams.score(tokens, word_grams.train(tokens, discounts, word_grams.words(counted, "rid", "mark")))
    none = lambda kind: F.lit(None).cast(kind)
    # Rows and sums meet in one aggregate; equal rows are counted there and come out as often.
    both = read.select(
        "rid", "doc_id", "lang", F.lit(1).alias("copies"), none("bigint").alias("n"), none("double").alias("logp"), none("double").alias("logp_seen")
    ).unionByName(
        sums.select(
            "rid", none("bigint").alias("doc_id"), none("string").alias("lang"), F.lit(0).alias("copies"), F.col("n_symbols").alias("n"), "logp", "logp_seen"
        )
    )
    one = both.groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"), F.max("lang").alias("lang"), F.sum("copies").alias("copies"), F.sum("n").alias("n"),
        F.sum("logp").alias("logp"), F.sum("logp_seen").alias("logp_seen"),
    )
    one = one.select(
        "doc_id", "lang", "copies", F.coalesce((F.col("n") / F.col("copies")).cast("long"), F.lit(0).cast("long")).alias("n_symbols"),
        F.exp(-F.col("logp") / F.col("n")).alias("perplexity"), F.exp(-F.col("logp_seen") / F.col("n")).alias("p"),
    )
    one = write_out(one, "kn-scored")
    one = one.withColumn("language", _language())
    known = one.filter("p is not null").join(F.broadcast(marked.filter(F.col("how").bitwiseAND(word_grams.ASKED) != 0)), "doc_id")
    per, whole = _thresholds(write_out(known.select("language", "good", "p"), "kn-known"), quantiles)
    # The bound is not below what the counted trusted texts themselves come to.
    own = one.join(trusted, "doc_id", "left_semi").groupBy("language").agg(F.percentile_approx("perplexity", quantiles[2], 10000).alias("own"))
    found = F.coalesce("points", whole)
    last = F.greatest(found[2], F.col("own"))
    cuts = write_out(per.join(own, "language", "full").select("language", F.array(found[0], found[1], last).alias("_cut")), "kn-cuts")
    df = one.join(cuts, "language", "left").withColumn("_cut", F.coalesce("_cut", whole))
    df = df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    p = F.col("perplexity")
    bucket = F.when(p.isNull(), None).when(p <= F.col("_cut")[0], "head").when(p <= F.col("_cut")[1], "middle").otherwise("tail")
    return df.select(
        "doc_id", "lang", "n_symbols", "perplexity", F.col("_cut")[2].alias("threshold"), bucket.alias("bucket"),
        F.coalesce(p <= F.col("_cut")[2], F.lit(False)).alias("kept"),
    )
