"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Every document gets exact counts (words, symbols, repeated lines, words in repeated three-word windows).  A
rule compares a ratio of counts with a cutoff; the cutoffs of each stratum (language) come from the
labelled documents: a cutoff is admitted if an exact binomial test (the one-sided Clopper-Pearson bound) shows
that it rejects at most the allowed share of good documents.  Cutoffs of a rule are tested from the most
lenient one on and testing stops at the first failure (fixed sequence), the error level is divided by
rules and strata (Bonferroni), and the allowed share is divided by the rules, so all rules
together reject at most ``RISK`` of a stratum's good documents with confidence 1 - ``DELTA``.

``joint`` calibration tests all rules together instead (``JOINT``, one fixed sequence of cutoff vectors, each at least as strict as
the one before), on the good documents that pass the base rule, with the whole share and the error level divided by strata only.
A stratum of too few such documents takes the vector of all strata pooled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: share of good documents that all rules together may reject in a stratum, and the error level of that guarantee
RISK, DELTA = 0.01, 0.05

# fixed values: rule -> (numerator, denominator, cutoffs in hundredths from lenient to strict); a document
# fails if 100 * numerator > cutoff * denominator
RULES = {
    "symbols": ("n_symbols", "n_words", (200, 150, 100, 75, 50, 40, 30, 20, 15, 10)),
    "dup_lines": ("n_dup_lines", "n_lines", (90, 80, 70, 60, 50, 40, 30, 20)),
    "repeat_words": ("n_repeat_words", "n_words", (45, 40, 35, 30, 25, 20, 15)),
    "capitals": ("n_capitals", "word_chars", (90, 80, 70, 60, 50, 40, 30, 20)),
}

#: cutoff vectors from lenient to strict; each tightens one rule by a step, all rules advance evenly through their lists
JOINT = [{rule: cutoffs[0] for rule, (_, _, cutoffs) in RULES.items()}]
for _, _rule, _cutoff in sorted(((k / (len(c) - 1), rule, c[k]) for rule, (_, _, c) in RULES.items() for k in range(1, len(c))), key=lambda x: (x[0], [*RULES].index(x[1]))):
    JOINT.append(JOINT[-1] | {_rule: _cutoff})

#: what is rejected whatever the labels say
BASE = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"

_SPACE, _SYMBOLS, _CAPITALS = " \t\n\x0b\f\r", "#*$%&|<>", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _chars(text: Column, of: str) -> Column:
    """Characters of ``text`` that are in ``of``."""
    return F.length(text) - F.length(F.translate(text, of, ""))


def text_counts(docs: DataFrame, id_col: str, text_col: str, keep: dict[str, Column]) -> DataFrame:
    """Exact counts per document; ``keep``: further columns by name."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).alias("_id"), text.alias("_t"), *[c.alias(k) for k, c in keep.items()])
    split = base.withColumns(
        {
            "_w": F.expr(r"filter(split(_t, '[ \\t-\\r]+'), w -> w != '')"),
            "_lines": F.expr(r"filter(split(_t, '\\n'), l -> translate(l, ' \t\n\u000b\u000c\r', '') != '')"),
        }
    )
    # a window is the hash of its three words' hashes; equal windows meet by sorting (hash, position)
    hashed = split.withColumn("_h", F.expr("transform(_w, w -> xxhash64(w))"))
    windows = hashed.withColumn(
        "_g",
        F.expr("transform(slice(_h, 1, greatest(size(_h) - 2, 0)), (h, i) -> xxhash64(h, get(_h, i + 1), get(_h, i + 2)))"),
    )
    met = windows.withColumn(
        "_s",
        F.expr(
            "CASE WHEN size(array_distinct(_g)) < size(_g) THEN sort_array(transform(_g, (g, i) -> struct(g AS g, i AS i)))"
            " ELSE array() END"
        ),
    )
    twice = met.withColumn(
        "_p",
        F.expr("array_sort(transform(filter(_s, (x, i) -> get(_s, i - 1).g = x.g OR get(_s, i + 1).g = x.g), x -> x.i))"),
    )
    covered = "aggregate(_p, struct(0L AS n, -3 AS last), (a, p) -> struct(a.n + least(3, p - a.last) AS n, p AS last), a -> a.n)"
    t = F.col("_t")
    return twice.select(
        F.col("_id"),
        *keep,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.translate(t, _SPACE, "")).cast("long").alias("word_chars"),
        _chars(t, _SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr(covered).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        _chars(t, _CAPITALS).cast("long").alias("n_capitals"),
    )


def _fails(rule: str, cutoff: Column) -> Column:
    num, den, _ = RULES[rule]
    return 100 * F.col(num) > cutoff * F.col(den)


def _admitted(share: float, level: float) -> Column:
    """Whether the exact test of k rejected of n admits a cutoff."""
    # P(X <= k) for X ~ Binomial(n, share), its terms built from one another in logarithms; past the mean it is no small number
    cdf = f"""aggregate(sequence(0, int(k)), struct(double(n) * ln(1 - {share!r}D) AS t, 0D AS p),
        (a, i) -> struct(a.t + ln(greatest(n - i, 1) / (i + 1D)) + ln({share!r}D / (1 - {share!r}D)) AS t, a.p + exp(a.t) AS p), a -> a.p)"""
    return F.expr(f"k <= n * {share!r}D AND (CASE WHEN k <= n * {share!r}D THEN {cdf} ELSE 1D END) <= {level!r}D")


def calibrate(counts: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, cutoff): the strictest admitted cutoff of each rule and stratum.

    ``counts`` has _id, stratum and the counts, ``labels`` has _id and good.  One row per stratum, rule and tested cutoff is
    all that leaves the aggregate, whatever the corpus size.
    """
    good = counts.join(labels.filter("good").select("_id"), "_id")  # ids may repeat: each pair is a labelled row
    tested = good.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(
            *[
                F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("cutoff"), F.sum(_fails(rule, F.lit(c)).cast("long")).alias("k"))
                for rule, (_, _, cutoffs) in RULES.items()
                for c in cutoffs
            ]
        ).alias("t"),
    )
    tested = materialize(tested)  # a row per stratum
    share, level = risk / len(RULES), delta / (max(tested.count(), 1) * len(RULES))
    cells = tested.select("stratum", "n", F.inline("t"))
    judged = cells.withColumn("ok", _admitted(share, level))
    return (
        judged.groupBy("stratum", "rule")
        .agg(F.max(F.when(~F.col("ok"), F.col("cutoff"))).alias("failed"), F.collect_list(F.when(F.col("ok"), F.col("cutoff"))).alias("oks"))
        .select("stratum", "rule", F.expr("array_min(filter(oks, c -> c > coalesce(failed, -1)))").alias("cutoff"))
        .filter("cutoff IS NOT NULL")
    )


def calibrate_jointly(counts: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA, strata: DataFrame | None = None) -> DataFrame:
    """(stratum, rule, cutoff) of the strictest admitted vector of ``JOINT`` for each row of ``strata`` (distinct
    strata; by default those of ``counts``).

    A stratum whose good documents are too few to admit a vector that rejects none of them takes the strictest vector that the good
    documents of all strata together admit; its bound then holds for all strata pooled.  Those strata share one test, so there are never more
    tests than strata, each at ``delta`` / strata.  A stratum with documents enough whose own test admits nothing has no row.
    """
    good = counts.join(labels.filter("good").select("_id"), "_id")  # no filter by BASE: the optimizer would copy the counting into it
    fails = [" OR ".join(f"100 * {RULES[rule][0]} > {cutoff} * {RULES[rule][1]}" for rule, cutoff in vector.items()) for vector in JOINT]
    tested = materialize(
        good.groupBy("stratum").agg(
            F.count(F.when(F.expr(f"NOT ({BASE})"), 1)).alias("n"),
            F.array(*[F.struct(F.lit(step).alias("step"), F.count(F.when(F.expr(f"NOT ({BASE}) AND ({f})"), 1)).alias("k")) for step, f in enumerate(fails)]).alias("t"),
        )
    )
    strata = materialize(strata if strata is not None else counts.select("stratum").distinct())
    level = delta / max(strata.count(), 1)
    cells = tested.select("stratum", "n", F.inline("t"))
    pooled = cells.groupBy("step").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).filter(_admitted(risk, level)).agg(F.max("step")).first()[0]
    # a stricter vector rejects no less, so the admitted ones are those before the first failure
    own = cells.groupBy(F.col("stratum").alias("_own")).agg(F.max(F.when(_admitted(risk, level), F.col("step"))).alias("step"), F.max("n").alias("n"))
    large = F.expr(f"coalesce(n * ln(1 - {risk!r}D) <= ln({level!r}D), false)")
    chosen = strata.join(own, F.col("stratum").eqNullSafe(F.col("_own")), "left").select("stratum", F.when(large, F.col("step")).otherwise(F.lit(pooled).cast("int")).alias("step"))
    vectors = F.array(*[F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(cutoff).alias("cutoff")) for rule, cutoff in vector.items()]) for vector in JOINT])
    return chosen.filter("step IS NOT NULL").select("stratum", F.inline(F.get(vectors, F.col("step"))))


def judge_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    good: str = "quality = 1",
    risk: float = RISK,
    delta: float = DELTA,
    keep: dict[str, Column] | None = None,
    joint: bool = False,
) -> DataFrame:
    """Counts and verdict of every document: (id, counts, base_failed, kept, extra columns named in ``keep``).

    Words are runs of other than the six ASCII white-space characters.  ``base_failed``: under 50 words, or over half of the
    words in repeated three-word windows.  ``kept`` is false if base_failed or if a rule's admitted cutoff
    for the document's stratum is passed.  A null text counts as empty.  A stratum without labelled good
    documents enough for the test (a null one too, unless labelled) has no cutoffs, so only the base rule acts; with ``joint``
    it takes the pooled cutoffs, if all strata together have documents enough (see ``calibrate_jointly``).  Repeated rows stay; an
    empty table gives an empty result; labels of unknown documents and null labels are ignored.
    """
    keep, stratum = keep or {}, {"stratum": F.col(stratum_col).cast("string")}
    marked = labels.select(F.col(id_col).alias("_id"), F.expr(good).alias("good"))
    if keep:
        # with further columns, texts perhaps, counting again is cheaper than storing them; for the cutoffs only the documents
        # labelled good are counted
        known = marked.filter("good").select(F.col("_id").alias(id_col)).distinct()
        narrow = text_counts(docs.select(*dict.fromkeys((id_col, text_col, stratum_col))).join(known, id_col, "left_semi"), id_col, text_col, stratum)
        # a generator: the optimizer would copy the counting into every condition on it
        counts = text_counts(docs, id_col, text_col, stratum | keep)
        names = [c for c in counts.columns if c not in ("_id", "stratum", *keep)]
        counts = counts.select("_id", "stratum", *keep, F.inline(F.array(F.struct(*names))))
    else:
        counts = narrow = materialize(text_counts(docs, id_col, text_col, stratum))
    if joint:
        admitted = calibrate_jointly(narrow, marked, risk, delta, docs.select(stratum["stratum"].alias("stratum")).distinct())
    else:
        admitted = calibrate(narrow, marked, risk, delta)
    cutoffs = admitted.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cut")).withColumnRenamed("stratum", "_stratum")
    base = F.expr(BASE)
    passed = [F.coalesce(_fails(rule, F.col("cut")[rule]), F.lit(False)) for rule in RULES]
    failed = passed[0]
    for p in passed[1:]:
        failed = failed | p
    return (
        counts.join(F.broadcast(cutoffs), F.col("stratum").eqNullSafe(F.col("_stratum")), "left")  # a row per stratum
        .select(F.col("_id").alias(id_col), *COUNTS, base.alias("base_failed"), (~(base | failed)).alias("kept"), *keep)
    )
