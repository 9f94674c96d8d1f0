"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Every rule rejects documents whose measure is above its cutoff. The cutoffs of all rules walk one ladder together: each rule has a unit (about
what published rule sets use for it), and a step of the ladder sets every cutoff to the same multiple of its unit. For each stratum the
verdict is the strictest step for which the labelled good documents prove, by the exact binomial test, that at most ``risk`` of the good
documents of the stratum are rejected by any rule. The ladder is walked from lenient to strict and stops at the first failure
(fixed-sequence testing, no correction needed along it); strata share the error probability (Bonferroni). With all tests holding together with
probability ``1 - error``, no stratum loses more than ``risk`` of its good documents to the rules. All strata are tested alike; one with too few
labels to prove anything rejects nothing (``ln(error / strata) / ln(1 - risk)`` are needed: 217 at 2 %, 5 % and four strata).
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe.session import broadcast_if_small, cut_lineage, scratch_path

SYMBOLS = "#*$%&|<>"
_SPACES = "\t\n\x0b\x0c\r "
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

#: Measures in thousandths: symbols, capitals and marks among word characters, words in repeated windows.
RULES: dict[str, Callable[[], Column]] = {
    "symbols": lambda: _per_mille("n_symbols", "word_chars"),
    "capitals": lambda: _per_mille("n_capitals", "word_chars"),
    "marks": lambda: _per_mille("n_marks", "word_chars"),
    "repeats": lambda: _per_mille("n_repeat_words", "n_words"),
}
#: The cutoff of each rule, in thousandths, at a multiple of one.
UNITS = {"symbols": 20, "capitals": 100, "marks": 20, "repeats": 180}
#: Multiples of the units in tenths, strict to lenient.
LADDER = [5, 8, 10, 12, 15, 20, 25, 30, 40, 50, 60, 80, 100, 150, 200]


def _cutoff(rule: str, tenths: int) -> int:
    return UNITS[rule] * tenths // 10


def _per_mille(part: str, whole: str) -> Column:
    return F.expr(f"1000 * {part} div greatest({whole}, 1L)")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, also where ``use`` reads it inside lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _call(name: str, *columns: Column) -> Column:
    return F.call_function(name, *columns)


def words_of(text: Column) -> Column:
    """The words of a text, as an array; none for a null text."""
    spaced = F.translate(F.coalesce(text, F.lit("")), _SPACES, " " * len(_SPACES))
    return F.array_remove(F.split(spaced, " "), "")


def _repeated(hashes: Column, places: Column, bits: Column, width: int, seed: int) -> Column:
    """The places whose window of hashes occurs at another of ``places`` too.

    Each place is sorted behind the low bits of its window's hash, so equal windows become neighbours.
    """
    key = F.transform(
        places,
        lambda p: _call("shiftleft", F.xxhash64(F.lit(seed), *[F.get(hashes, p + i) for i in range(width)]), bits)
        + p.cast("long"),
    )

    def equal(a: Column, b: Column) -> Column:
        return _call("shiftright", a, bits) == _call("shiftright", b, bits)

    def neighbours(keys: Column) -> Column:
        same = F.filter(keys, lambda k, i: equal(k, F.get(keys, i - 1)) | equal(k, F.get(keys, i + 1)))
        return F.transform(same, lambda k: k.bitwiseAND(_call("shiftleft", F.lit(1).cast("long"), bits) - 1).cast("int"))

    return _let(F.sort_array(key), neighbours)


def repeated_words(words: Column, width: int = 3) -> Column:
    """How many words lie in a window of ``width`` words that is found twice or more in the text.

    Windows are compared by two independent hashes (the second only where the first found a partner), so a chance match needs
    far more than 64 equal bits less those that number the places.
    """
    count = F.size(words)
    bits = F.length(F.bin(count))

    def covered(places: Column) -> Column:
        step = F.transform(places, lambda p, i: F.least(F.lit(width), F.coalesce(F.get(places, i + 1) - p, F.lit(width))))
        return F.aggregate(step, F.lit(0), lambda total, n: total + n)

    def found(hashes: Column) -> Column:
        def again(bound: Column) -> Column:
            first = _repeated(hashes, F.sequence(F.lit(0), F.size(hashes) - width), bound, width, 1)
            return _let(first, lambda p: _repeated(hashes, p, bound, width, 2))

        return _let(F.sort_array(_let(bits, again)), covered)

    whole = _let(F.transform(words, lambda w: F.xxhash64(w)), found)
    return F.when(count > width, whole).otherwise(0).cast("long")


def measure(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """``keep`` and the counts the rules use, one row per document; a null text has no words and no lines."""
    names = docs.select(*keep).columns
    text = F.coalesce(F.col("text"), F.lit(""))

    def chars(of: str) -> Column:
        return (F.char_length("__text") - F.char_length(F.translate("__text", of, ""))).cast("long")

    lines = F.filter(F.split("__text", "\n"), lambda line: F.length(F.translate(line, _SPACES, "")) > 0)
    return (
        docs.select(*keep, text.alias("__text"), words_of(text).alias("__words"))
        .select(
            *names,
            F.size("__words").cast("long").alias("n_words"),
            F.char_length(F.translate("__text", _SPACES, "")).cast("long").alias("word_chars"),
            chars(SYMBOLS).alias("n_symbols"),
            _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeated_words(F.col("__words")).alias("n_repeat_words"),
            chars(_UPPER).alias("n_capitals"),
            chars("!").alias("n_marks"),
        )
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _log_factorial(n: Column) -> Column:
    """ln(n!) by Stirling's series at n + 9, good to about 1e-10."""
    y = n + F.lit(9.0)
    shift = sum((F.log(n + F.lit(float(i))) for i in range(2, 9)), F.log(n + F.lit(1.0)))
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k) where k < n p, and 1 elsewhere (no test passes there).

    Terms are summed from k downward; after 64 + 12 sqrt(n) of them the rest is replaced by its geometric upper bound, which
    is below the sum's rounding error and can only make a test stricter.
    """
    kd, nd = k.cast("double"), n.cast("double")
    top = F.exp(
        _log_factorial(nd) - _log_factorial(kd) - _log_factorial(nd - kd) + kd * math.log(p) + (nd - kd) * math.log1p(-p)
    )
    steps = F.least(k, (64 + 12 * F.sqrt(nd)).cast("long"))
    odds = (1 - p) / p

    def ratio(j: Column) -> Column:
        return (kd - j + 1) / (nd - kd + j) * odds

    start = F.struct(top.alias("term"), top.alias("total"))

    def add(state: Column, j: Column) -> Column:
        term = state["term"] * ratio(j.cast("double"))
        return F.struct(term.alias("term"), (state["total"] + term).alias("total"))

    folded = F.aggregate(
        F.when(steps > 0, F.sequence(F.lit(1).cast("long"), steps)).otherwise(F.array().cast("array<bigint>")), start, add
    )
    last = ratio(steps.cast("double") + 1)
    whole = _let(folded, lambda s: s["total"] + F.when(steps < k, s["term"] * last / (1 - last)).otherwise(F.lit(0.0)))
    return F.when(kd < nd * p, F.least(whole, F.lit(1.0))).otherwise(F.lit(1.0))


def _above(cutoff: Callable[[str], Column]) -> Column:
    """Whether any rule's measure is above its cutoff; a null cutoff rejects nothing."""
    return reduce(or_, (F.coalesce(make() > cutoff(name), F.lit(False)) for name, make in RULES.items()))


def cutoffs(measured: DataFrame, labels: DataFrame, stratum: str, risk: float = 0.02, error: float = 0.05) -> DataFrame:
    """The stratum and ``cut_<rule>`` of every rule at the strictest proven step; no row for a stratum where none is proven.

    The holdout is every labelled good document that passes the base rules. A document labelled more than once counts as good
    if one label says so; rows without id or quality count for nothing.
    """
    good = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality")).where("quality = 1")
    holdout = measured.where(~base_failed()).join(good, F.col("__id") == F.col("doc_id"), "left_semi")
    rejected = [F.sum(_above(lambda rule, t=t: F.lit(_cutoff(rule, t))).cast("long")) for t in LADDER]
    counted = holdout.groupBy(stratum).agg(F.count("*").alias("n"), F.array(*rejected).alias("ks"))
    level = F.lit(error) / counted.agg(F.count("*")).scalar()
    tested = counted.select(stratum, "n", F.posexplode("ks").alias("pos", "k"))
    # The tail grows with k and k with strictness, so the passing steps are the lenient end of the ladder.
    passed = tested.where(binomial_tail(F.col("k"), F.col("n"), risk) <= level).groupBy(stratum).agg(F.min("pos").alias("step"))
    steps = {name: F.array(*[F.lit(_cutoff(name, t)) for t in LADDER]) for name in RULES}
    return passed.select(stratum, *[F.get(values, F.col("step")).alias(f"cut_{name}") for name, values in steps.items()])


_TEXT_KEY = [F.xxhash64, lambda text: F.xxhash64(F.lit(1), text)]


def _verdicts(rows: DataFrame, proven: DataFrame) -> DataFrame:
    """``rows`` with ``base_failed`` and ``kept``."""
    # One row per stratum, materialised and counted, so that texts need not be shuffled to meet it.
    wide = broadcast_if_small(cut_lineage(proven.withColumnRenamed("__stratum", "__proven")))
    # A caller's filter on the verdict must stay above the counts: pushed below, it would compute them a second time.
    joined = rows.withColumn("__here", F.monotonically_increasing_id()).join(
        wide, F.col("__stratum").eqNullSafe(F.col("__proven")), "left"
    )
    kept = ~base_failed() & ~_above(lambda rule: F.col(f"cut_{rule}")) & (F.col("__here") >= 0)
    return joined.withColumns({"base_failed": base_failed(), "kept": kept})


def _measured(docs: DataFrame, stratum: str) -> DataFrame:
    """The counts of every row, written once to the shared folder, with its id, stratum and two hashes of its text."""
    path = scratch_path(docs.sparkSession, "quality")
    key = [make(F.col("text")).alias(f"__key{i}") for i, make in enumerate(_TEXT_KEY)]
    measure(docs, [F.col("doc_id").alias("__id"), F.col(stratum).alias("__stratum"), *key]).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def judge(
    docs: DataFrame, labels: DataFrame, keep: list[str], stratum: str = "lang", risk: float = 0.02, error: float = 0.05
) -> DataFrame:
    """``keep``, the counts, ``base_failed`` and ``kept`` per document (null and repeated rows included, each judged by itself).

    The counts the tests need are written once to the shared folder, without ``keep``. If ``keep`` is no more than that, the verdicts
    come from there; otherwise documents are measured again where they are read, which costs time but no second copy of them. A null
    stratum is a stratum of its own. Other columns of ``docs`` are not read; names in ``keep`` must differ from the results.
    """
    clash = {*COUNTS, "base_failed", "kept"} & set(keep)
    if clash:
        raise ValueError(f"these names are taken by results: {sorted(clash)}")
    measured = _measured(docs, stratum)
    proven = cutoffs(measured, labels, "__stratum", risk, error)
    if keep == ["doc_id"]:
        rows = measured.select(F.struct(F.col("__id").alias("doc_id")).alias("__row"), *measured.columns)
    else:
        named = [F.col("doc_id").alias("__id"), F.col(stratum).alias("__stratum")]
        rows = measure(docs, [F.struct(*[F.col(k) for k in keep]).alias("__row"), *named])
    return _verdicts(rows, proven).select("__row.*", *COUNTS, "base_failed", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.02, error: float = 0.05) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, unchanged, whatever other columns they have.

    Texts are measured once. The rows rejected are known by id, stratum and two 64-bit hashes of the text, on which alone a verdict depends, and
    the documents lose them by an anti join; repeated rows share their verdict.
    """
    measured = _measured(docs, stratum)
    judged = _verdicts(measured, cutoffs(measured, labels, "__stratum", risk, error))
    keys = ["__id", "__stratum", *[f"__key{i}" for i in range(len(_TEXT_KEY))]]
    rejected = judged.where(~F.col("kept")).select(*[F.col(k).alias(f"{k}_out") for k in keys]).distinct()
    found = [F.col("doc_id"), F.col(stratum), *[make(F.col("text")) for make in _TEXT_KEY]]
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"), *[c.alias(k) for c, k in zip(found, keys)]
    )
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"{k}_out")) for k in keys))
    return whole.join(rejected, same, "left_anti").select("__doc.*")


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge(docs, labels, ["doc_id"])


def quality_sql(risk: float = 0.02, error: float = 0.05) -> str:
    """The same in DuckDB's SQL."""
    space = r"[\x20\x09-\x0D]"
    measures = {
        "symbols": ("n_symbols", "word_chars"), "capitals": ("n_capitals", "word_chars"),
        "marks": ("n_marks", "word_chars"), "repeats": ("n_repeat_words", "n_words"),
    }
    ratio = ", ".join(f"1000 * {a} // greatest({b}, 1) AS m_{name}" for name, (a, b) in measures.items())
    over = " OR ".join(f"m_{name} > {UNITS[name]} * c // 10" for name in measures)
    pmf = (
        f"exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({risk!r}) + (n - i) * ln(1 - {risk!r}))"
    )
    step = "(SELECT min(c) FROM passed p WHERE p.lang IS NOT DISTINCT FROM f.lang)"
    return f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, lang, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
windows AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS j) GROUP BY doc_id),
m AS (SELECT w.doc_id, lang, len(ws)::BIGINT AS n_words,
        length(regexp_replace(text, '{space}', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(c.n, 0)::BIGINT AS n_repeat_words,
        length(regexp_replace(text, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals,
        length(regexp_replace(text, '[^!]', '', 'g'))::BIGINT AS n_marks
      FROM w LEFT JOIN covered c ON c.doc_id = w.doc_id),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {ratio} FROM m),
holdout AS (SELECT * FROM f WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels GROUP BY doc_id HAVING max(quality) = 1)),
ladder AS (SELECT unnest({LADDER}) AS c),
tests AS (SELECT lang, c, count(*) AS n, count(*) FILTER ({over}) AS k FROM holdout, ladder GROUP BY lang, c),
tail AS (SELECT lang, c,
           CASE WHEN k < n * {risk!r} THEN (SELECT sum({pmf}) FROM (SELECT unnest(range(0, k + 1)) AS i)) ELSE 1 END AS tail FROM tests),
passed AS (SELECT * FROM tail WHERE tail <= {error!r} / (SELECT count(*) FROM (SELECT DISTINCT lang FROM holdout))),
stepped AS (SELECT *, {step} AS c FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce({over}, false) AS kept
FROM stepped
"""
