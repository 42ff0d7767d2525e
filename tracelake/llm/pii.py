"""Personal data by candidate gradient boosting (operator 2). DataFrame and SQL functions and Spark ML only.

Base spans follow fixed patterns and checks and always stay. Wider patterns
propose more spans, overlapping across kinds: addresses written out, numbers
without a plus sign, other groupings. Boosted trees score them by format and
context. They learn from candidates that are known without a person: those
that hold a base span are right, those that break the rule of their own form
(checksum, range, number of digits or groups, no domain) are wrong. Addresses
written out, IPv6 and cards of 12 to 15 digits that keep theirs are of neither
sort; addresses are scored as if written with signs. What tells the two apart by definition
(plus sign, at sign, checksum) is no feature, so that a score speaks for
candidates of neither sort. Per kind, the threshold is the least score above
which held-out candidates are right often enough; a kind without enough of
them, or whose classes can't be told apart, adds nothing.

Fitting the trees takes a bounded sample of candidates by hash, of each kind
alike (`SAMPLE`); everything else, the thresholds too, covers all rows. Positions are code points, ends exclusive. Null text:
empty, no spans. Rows are numbered once in a written table, so repeated
doc_ids and rows stay apart. Extra columns are left. An empty table gives no
rows. Texts of any length are read whole; patterns are possessive, so long
runs cost linear time and no stack.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tracelake.llm.shared import text_rows, work_folder, written

KINDS = ("email", "ip", "card", "phone")
#: Fixed patterns of the base spans; a match begins where a run of its characters begins or where the last match ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT = r"(?:@|\x20?\((?:at|AT)\)\x20?|\x20?\[(?:at|AT)\]\x20?|\x20(?:at|AT)\x20)"
_DOT = r"(?:\.|\x20?\((?:dot|DOT)\)\x20?|\x20?\[(?:dot|DOT)\]\x20?|\x20(?:dot|DOT)\x20)"
#: Patterns of the proposals.
WIDE = {
    "email": rf"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,4}+(?:\.[0-9]{1,4}+){3}+|(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{0,4}+:){2,7}+[0-9A-Fa-f]{1,4}+",
    "card": r"(?<![0-9])[0-9](?:[\x20.-]?+[0-9]){11,22}+(?![0-9])",
    "phone": r"(?:\+|\b00)?(?:\([0-9]{1,5}+\)|(?<![0-9])[0-9]{1,5}+)(?:[\x20./-]{1,2}+\(?[0-9]{2,6}+\)?){1,5}+",
}
TRIGGER = {"email": "@|(?i)[ (\\[]at[ )\\]]", "ip": "[0-9][.]|:", "card": "[0-9]{4}|[0-9][ .-][0-9]", "phone": "[0-9]{2}"}
#: Of the base patterns, where theirs is wider.
BASE_TRIGGER = {"phone": r"\+[0-9]"}
CONTEXT = 24
WORDS_BEFORE = {
    "email": r"(?i)\b(e-?mail|mail|contact|write|reach)\b", "ip": r"(?i)\b(ip|ipv6|host|server|address|login|from)\b",
    "card": r"(?i)\b(card|visa|credit|payment|paid|account)\b", "phone": r"(?i)\b(phone|tel|telephone|mobile|cell|call|fax|dial)\b"}
#: Candidates for training at most; a quarter of all and those beyond the sample are held out. What a threshold must reach on how many held-out ones.
SAMPLE = 40_000
PRECISION, LEAST_HELD = 0.98, 20
TREES, DEPTH, SEED = 12, 3, 42
FEATURES = ("kind_no", "size", "digits", "letters", "marks", "spaces", "groups", "last_group", "longest_group", "distinct_digits", "word_before",
            "touches_before", "touches_after", "digit_before", "digit_after")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    at = F.sequence(F.lit(1), F.length(digits))
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    digit = lambda i: F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
    return F.aggregate(at, F.lit(0), lambda total, i: total + F.when(i % 2 == 0, doubled(digit(i))).otherwise(digit(i))) % 10 == 0


def rule(kind: str, match: Column) -> Column:
    """The check of a kind."""
    n = F.length(_digits(match))
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
    return {"email": F.lit(True), "ip": match.rlike(rf"^{part}(?:\.{part}){{3}}$"),
            "card": n.between(16, 19) & luhn(F.when(n.between(16, 19), _digits(match)).otherwise("1")), "phone": n.between(8, 15)}[kind]


def _plain(match: Column) -> Column:
    """An address written out, with its signs; a bare " at " before a literal dot stays as it is, text is full of those."""
    signed = F.regexp_replace(F.regexp_replace(match, _DOT, "."), _AT, "@")
    return F.when(match.rlike(r"[\[(](?:at|AT)[\])]|" + _DOT.replace(r"\.|", "", 1)), signed).otherwise(match)


def impossible(kind: str, match: Column) -> Column:
    """Whether a candidate breaks the rule of its own form, so that it is surely no personal data."""
    n = F.length(_digits(match))
    address = F.regexp_replace(F.regexp_replace(match, _DOT, "."), _AT, "@")
    outside = ~F.substring_index(address, ".", -1).rlike("^(?:[A-Za-z]{2,}|xn--[A-Za-z0-9-]+)$")
    groups = F.split(match, ":", -1)
    filled = F.size(F.filter(groups, lambda g: g != ""))
    short = ~match.rlike(":::|::.*::|^:[^:]") & (filled <= 7)
    six = F.when(match.contains("::"), short).otherwise((F.size(groups) == 8) & (filled == 8))
    return {"email": outside | address.rlike(r"^\.|\.@|\.\.|@-|-\.|\.-") | (~match.contains("@") & address.rlike(r"(?i)@www\.")),
            "ip": F.when(match.contains(":"), ~six).otherwise(~rule("ip", match)),
            "card": ~n.between(12, 19) | ~luhn(F.when(n.between(12, 19), _digits(match)).otherwise("1")), "phone": ~rule("phone", match)}[kind]


def _found(text: Column, pattern: str, trigger: str) -> Column:
    """Matches with the length of the text since the last one and what stands around; the last entry has no match."""
    there = text.rlike(trigger)
    matches = F.when(there, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    pieces = F.when(there, F.split(text, pattern, -1)).otherwise(F.array().cast("array<string>"))
    gaps = F.transform(pieces, lambda p: F.struct(F.length(p).alias("gap"), F.right(p, F.lit(CONTEXT)).alias("before"), F.left(p, F.lit(1)).alias("first")))
    return F.when(F.size(matches) > 0, F.arrays_zip(gaps.alias("gaps"), matches.alias("matches"))).otherwise(None)


def _spans(numbered: DataFrame, column: str, kind: str) -> DataFrame:
    """row_no, kind_no, match, before, after, start, stop; positions are running sums over a document's matches."""
    rows = numbered.where(F.col(column).isNotNull()).select("row_no", F.posexplode(column).alias("i", "x"))
    rows = rows.select("row_no", "i", F.col("x.gaps.gap").alias("gap"), F.col("x.gaps.before").alias("before"), F.col("x.gaps.first").alias("first"), F.col("x.matches").alias("match"))
    order = Window.partitionBy("row_no").orderBy("i")
    until = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stop = F.sum(F.col("gap") + F.coalesce(F.length("match"), F.lit(0))).over(until)
    rows = rows.select("row_no", "match", "before", F.lead("first").over(order).alias("after"), stop.alias("stop")).where("match IS NOT NULL")
    return rows.select("row_no", F.lit(KINDS.index(kind)).alias("kind_no"), "match", "before", "after", (F.col("stop") - F.length("match")).alias("start"), "stop")


def _scan(docs: DataFrame, folder: str) -> DataFrame:
    columns = [_found(F.col("text"), patterns[k], triggers[k]).alias(f"{name}_{k}") for name, patterns, triggers in (("base", BASE, TRIGGER | BASE_TRIGGER), ("wide", WIDE, TRIGGER)) for k in KINDS]
    return written(text_rows(docs).select(F.monotonically_increasing_id().alias("row_no"), "doc_id", *columns), folder, "scan")


def _all(numbered: DataFrame, name: str) -> DataFrame:
    return reduce(DataFrame.union, [_spans(numbered, f"{name}_{k}", k) for k in KINDS])


def _by_kind(make) -> Column:
    out = None
    for i, k in enumerate(KINDS):
        value = make(k)
        out = F.when(F.col("kind_no") == i, value) if out is None else out.when(F.col("kind_no") == i, value)
    return out


def featured(candidates: DataFrame) -> DataFrame:
    m, digits = F.when(F.col("kind_no") == 0, _plain(F.col("match"))).otherwise(F.col("match")), F.col("all_digits")
    groups = F.filter(F.split(m, "[^0-9A-Za-z]+", -1), lambda g: g != "")
    number = lambda c: c.cast("double")
    rows = candidates.withColumn("all_digits", _digits(m)).withColumn("parts", groups)
    return rows.select(
        "*", F.length(m).alias("size"), F.length(digits).alias("digits"), F.length(F.regexp_replace(m, "[^A-Za-z]", "")).alias("letters"),
        F.length(F.regexp_replace(m, r"[0-9A-Za-z\x20+@]", "")).alias("marks"), F.length(F.regexp_replace(m, r"[^\x20]", "")).alias("spaces"),
        F.size("parts").alias("groups"), F.length(F.element_at("parts", -1)).alias("last_group"),
        F.array_max(F.transform("parts", lambda g: F.length(g))).alias("longest_group"),
        F.size(F.array_distinct(F.split(digits, ""))).alias("distinct_digits"), number(_by_kind(lambda k: F.col("before").rlike(WORDS_BEFORE[k]))).alias("word_before"),
        number(F.col("before").rlike(r"[A-Za-z_]$")).alias("touches_before"), number(F.coalesce("after", F.lit("")).rlike(r"^[A-Za-z_]")).alias("touches_after"),
        number(F.col("before").rlike(r"[0-9][^A-Za-z]?$")).alias("digit_before"), number(F.coalesce("after", F.lit("")).rlike(r"^[0-9]")).alias("digit_after"))


def _touching(candidates: DataFrame, base: DataFrame) -> DataFrame:
    """Candidates with whether they overlap a base span of any kind (hit), and whether one of their own (right). One sort per document."""
    both = candidates.withColumn("is_base", F.lit(False)).unionByName(base.withColumn("is_base", F.lit(True)))

    def overlaps(keys: list[str]) -> Column:
        before = Window.partitionBy(*keys).orderBy("start", "stop", "is_base", "kind_no").rowsBetween(Window.unboundedPreceding, -1)
        after = Window.partitionBy(*keys).orderBy(F.desc("start"), F.desc("stop"), F.desc("is_base"), F.desc("kind_no")).rowsBetween(Window.unboundedPreceding, -1)
        end = F.max(F.when(F.col("is_base"), F.col("stop"))).over(before)
        begin = F.min(F.when(F.col("is_base"), F.col("start"))).over(after)
        return F.coalesce(end > F.col("start"), F.lit(False)) | F.coalesce(begin < F.col("stop"), F.lit(False))

    return both.withColumn("hit", overlaps(["row_no"])).withColumn("right", overlaps(["row_no", "kind_no"])).where("NOT is_base").drop("is_base")


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep").transform(rows.fillna(0, subset=list(FEATURES)))


def train(known: DataFrame, folder: str) -> tuple[GBTClassificationModel, dict[int, float]] | None:
    """Trees and a threshold per kind from all candidates with label, turn and held (out); None if the classes can't be learnt.

    The trees see the first of each kind by turn; the thresholds count all that
    come after those and all that are held out.
    """
    order = ["turn", "match", "row_no", "start"]
    parts = [known.where(~F.col("held") & (F.col("kind_no") == i)).orderBy(*order).limit(SAMPLE // len(KINDS)) for i in range(len(KINDS))]
    fit = written(reduce(DataFrame.union, parts), folder, "fit")
    last = {r.kind_no: r.turn for r in fit.groupBy("kind_no").agg(F.max("turn").alias("turn")).collect()}  # a row per kind
    unseen = F.col("held") | _by_kind(lambda k: F.col("turn") > F.lit(last.get(KINDS.index(k), -(1 << 63))))
    if fit.select("label").distinct().count() < 2:
        return None
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features", labelCol="label").fit(_assembled(fit))
    scored = _scored(known.where(unseen), model).select("kind_no", "label", F.floor(F.col("score") * 100).alias("bin"))
    above = Window.partitionBy("kind_no").orderBy(F.desc("bin"))
    bins = scored.groupBy("kind_no", "bin").agg(F.sum("label").alias("good"), F.count("*").alias("n"))
    running = bins.select("kind_no", "bin", F.sum("good").over(above).alias("good"), F.sum("n").over(above).alias("n"))
    enough = running.where((F.col("n") >= LEAST_HELD) & (F.col("good") >= PRECISION * F.col("n")))
    rows = enough.groupBy("kind_no").agg(F.min("bin").alias("bin")).collect()  # a row per kind
    wrong = {r.kind_no for r in known.where("label = 0").groupBy("kind_no").count().collect()}
    return model, {r.kind_no: max(r.bin / 100, 0.5) for r in rows if r.kind_no in wrong}


def _scored(rows: DataFrame, model: GBTClassificationModel) -> DataFrame:
    return model.transform(_assembled(rows)).withColumn("score", F.element_at(vector_to_array("probability"), 2))


def personal_data(docs: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """The numbered documents (row_no, doc_id) and all spans: row_no, kind_no, start, stop, base."""
    numbered = _scan(docs, folder)
    base = written(_all(numbered, "base").where(_by_kind(lambda k: rule(k, F.col("match")))), folder, "base")
    candidates = featured(_touching(_all(numbered, "wide"), base))
    candidates = candidates.withColumn("wrong", _by_kind(lambda k: impossible(k, F.col("match"))))
    taught = (F.col("kind_no") != KINDS.index("card")) | (F.col("digits") >= 16)  # no card of fewer digits is known to be right
    candidates = written(candidates.withColumn("label", F.when(F.col("right"), 1.0).when(~F.col("hit") & F.col("wrong") & taught, 0.0)), folder, "candidates")
    order = F.xxhash64("match", "before", "start")
    known = candidates.where("label IS NOT NULL").withColumn("turn", order).withColumn("held", F.pmod(F.xxhash64("turn"), F.lit(4)) == 0)
    spans = base.select("row_no", "kind_no", "start", "stop", F.lit(True).alias("base"))
    trained = train(known, folder)
    if trained and trained[1]:
        model, least = trained
        free = _scored(candidates.where("NOT hit AND NOT wrong"), model)
        chosen = free.where(_by_kind(lambda k: F.col("score") >= F.lit(least.get(KINDS.index(k), 2.0))))
        spans = spans.union(chosen.select("row_no", "kind_no", "start", "stop", F.lit(False)))
    return numbered.select("row_no", "doc_id"), written(spans, folder, "spans")


def span_table(docs: DataFrame, folder: str) -> DataFrame:
    """One row per document: counts of base spans by kind, digest of the base spans, all spans, and how many were added."""
    numbered, spans = personal_data(docs, folder)
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind_no") + 1)
    entry = F.struct("kind_no", "start", "stop", F.concat_ws(":", name, "start", "stop").alias("text"))
    listed = lambda c: F.array_join(F.transform(F.array_sort(c), lambda s: s["text"]), ",")
    counts = [F.count_if(F.col("base") & (F.col("kind_no") == i)).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    own = spans.groupBy("row_no").agg(*counts, F.collect_list(F.when(F.col("base"), entry)).alias("b"), F.collect_list(entry).alias("a"), F.count_if(~F.col("base")).alias("n_added"))
    own = own.select("row_no", *[f"n_{k}" for k in KINDS], listed("b").alias("b"), listed("a").alias("spans"), "n_added")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    rows = numbered.join(own, "row_no", "left")
    return rows.select("doc_id", *[zero(f"n_{k}") for k in KINDS], F.sha2(F.coalesce("b", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"), zero("n_added"))


def op2_pii(spark: SparkSession, sf: str) -> DataFrame:
    return span_table(spark.read.parquet(f"{sf}/documents.parquet"), work_folder(spark, "op2"))
