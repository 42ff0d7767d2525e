"""Fuzzy line deduplication by MinHash (operator 10). DataFrame and SQL functions only.

A line is compared trimmed and in lower case. Its signature holds 25 minimum
hashes of its five-character shingles, those at every place whatever the
line's length. The minima stand in a square of five by five, and each band is
a line of that square in one of three directions (the affine plane of order
five), so that two bands share one minimum at most: fifteen bands of five.
If minima are independent, lines of similarity 0.8 share a band in 98 of 100 cases, of 0.85 in 99.5, while
lines of the same language, alike to a tenth, all but never do. Two bits of each minimum
go along, and only lines that agree in sixteen of 25 are candidates (of pairs at 0.8 that share a band, one in 4,000 does not).

In a bucket of two lines they are one pair; in a larger one first every line
with the one of least id, then, once those links are merged, in buckets that are still large every line
with eight lines more, and once those are merged only pairs whose
lines are still in different components. The lines of buckets that still hold several components get a map of
1,024 bits: each different shingle turns one bit. Bits in which two maps differ are
never more than the shingles that only one of the lines has, and those are at most a ninth of both
sets' sizes at a similarity of 0.8; so pairs whose maps differ in more bits are left out of the candidates and no link is lost.
Large buckets are compared in blocks, which different tasks do. A candidate counts if the Jaccard
similarity of the sets of all five-character shingles is 0.8 or more, computed
exactly. Components keep the line that comes first by doc_id, text hash and
line number.

Shingles are rows: a generator over the line in a code of four bytes a
character, hashed and reduced to the minima within the task, so neither
the shingles nor the text are exchanged. Equal lines share one id (64-bit hash
of the compared form), so thousands of copies cost one row. Blank lines are neither
compared nor removed. A line of fewer than five characters is one shingle.
Null text: no lines; it stays null. Null doc_ids come before others. Rows
equal in doc_id and text count as one document and keep the same lines. Extra
columns are kept by `deduplicated` and left by `line_groups`. An empty table
gives no rows. Lines of any length are compared whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tracelake.llm.components import components
from tracelake.llm.shared import drop_folder, work_folder, written

SHINGLE = 5
SIMILARITY = 0.8
#: The minima are a square of this side; a prime.
SIDE = 5
#: Directions in the square along which its lines are bands.
DIRECTIONS = 3
#: Minima whose two bits agree in a candidate pair, at least.
AGREEING = 16
#: Up to so many lines of a bucket are compared pair by pair at once.
SMALL_BUCKET = 2
#: In buckets of more lines than this that hold several components, so many lines more lead before all that is apart is compared.
LARGE_BUCKET, LEADS = 16, 8
#: Longs in a line's map; a power of two.
MAP_WORDS = 16
#: Pairs of one line that a task verifies at most; lines of a bucket that meet the others in one task.
PER_TASK = 1024
#: Up to so many ids (8 MB) are broadcast to fetch their lines; more are joined by an exchange, with the same result.
BROADCAST_IDS = 1 << 20
WHITE = " \t\n\x0b\x0c\r"


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, line_no, line (compared form) of every line that is not blank."""
    own = F.transform(F.split(F.lower("text"), "\n", -1), lambda line: F.btrim(line, F.lit(WHITE)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.posexplode(own).alias("line_no", "line"))
    return rows.where("line <> ''")


def _wide(line: Column) -> Column:
    """Four bytes a character, so that a shingle is found by its place alone."""
    return F.encode(line, "UTF-32")


def _starts(wide: Column) -> Column:
    """Where shingles start, in bytes; a line of fewer characters than a shingle has one."""
    return F.sequence(F.lit(1), F.greatest(F.octet_length(wide) - 4 * SHINGLE + 1, F.lit(1)), F.lit(4))


def _hash_at(wide: Column, start: Column) -> Column:
    return F.xxhash64(F.substring(wide, start, F.lit(4 * SHINGLE)))


def shingles(wide: Column) -> Column:
    """The hashes of the shingles at every place, repeats included. As an element of an array the code is made once, not once a shingle."""
    return F.transform(F.array(wide), lambda own: F.transform(_starts(own), lambda start: _hash_at(own, start)))[0]


def _set(line: Column) -> Column:
    return F.array_distinct(shingles(_wide(line)))


def signatures(rows: DataFrame) -> DataFrame:
    """id and the minima of every different line. rows: id, line. Exclusive or with a constant orders the hashes anew for each minimum."""
    hashes = rows.select("id", _wide(F.col("line")).alias("wide")).select("id", "wide", F.explode(_starts(F.col("wide"))).alias("start"))
    hashes = hashes.select("id", _hash_at(F.col("wide"), F.col("start")).alias("h"))
    constants = [(0x9E3779B97F4A7C15 * (i + 1) & (1 << 64) - 1) for i in range(SIDE * SIDE)]
    least = [F.min(F.col("h").bitwiseXOR(F.lit(c - (1 << 64) if c >> 63 else c))).alias(f"m{i}") for i, c in enumerate(constants)]
    return hashes.groupBy("id").agg(*least)


def bands() -> list[list[int]]:
    """The minima of each band: the square's lines of slope 0, 1, ... ."""
    return [[x * SIDE + (first + slope * x) % SIDE for x in range(SIDE)] for slope in range(DIRECTIONS) for first in range(SIDE)]


def _keys() -> Column:
    return F.array(*[F.xxhash64(F.lit(i), *[F.col(f"m{j}") for j in band]) for i, band in enumerate(bands())])


def _sketch() -> Column:
    """The lowest two bits of every minimum, packed into a long."""
    parts = [F.shiftleft(F.col(f"m{i}").bitwiseAND(F.lit(3).cast("long")), 2 * i) for i in range(SIDE * SIDE)]
    return reduce(lambda x, y: x.bitwiseOR(y), parts)


def _agree(a: str, b: str) -> Column:
    apart = F.col(a).bitwiseXOR(F.col(b))
    low = F.lit(sum(1 << 2 * i for i in range(SIDE * SIDE))).cast("long")
    return F.bit_count(apart.bitwiseOR(F.shiftright(apart, 1)).bitwiseAND(low)) <= SIDE * SIDE - AGREEING


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The candidate pairs a, b whose lines are similar enough, by their exact shingle sets. texts: id, line.

    Lines travel as text; the set of a is made where its pairs meet it, once for up to PER_TASK of them.
    """
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a stated number: small tables are costly here, so they aren't merged
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(PER_TASK)).cast("int").alias("parts"))
    right = pairs.join(parts, "a").join(texts.select(F.col("id").alias("b"), F.col("line").alias("line_b")), "b")
    right = right.select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), "b", "line_b")
    left = texts.select(F.col("id").alias("a"), "line").join(parts, "a")
    left = left.select("a", "line", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).repartition(tasks, "a", "part")
    both = right.join(left.select("a", "part", _set(F.col("line")).alias("set_a")).hint("merge"), ["a", "part"])
    sets = both.select("a", "b", "set_a", F.explode(F.array(_set(F.col("line_b")))).alias("set_b"))  # a generator: evaluated once, not per use
    counted = sets.select("a", "b", (F.size("set_a") + F.size("set_b")).alias("sizes"), F.explode(F.array(F.size(F.array_intersect("set_a", "set_b")))).alias("shared"))
    return counted.where(F.col("shared") >= F.lit(SIMILARITY) * (F.col("sizes") - F.col("shared"))).select("a", "b")


def maps(texts: DataFrame) -> DataFrame:
    """id, size (different shingles), w0, w1, ...: a map of bits in which each different shingle turned one. texts: id, line, each id once."""
    hashes = texts.select("id", F.explode(_set(F.col("line"))).alias("h"))
    word = F.shiftrightunsigned("h", 64 - (MAP_WORDS - 1).bit_length())
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("h").bitwiseAND(F.lit(63).cast("long")).cast("int"))
    words = [F.bit_xor(F.when(word == i, bit).otherwise(F.lit(0).cast("long"))).alias(f"w{i}") for i in range(MAP_WORDS)]
    return hashes.groupBy("id").agg(F.count("*").cast("int").alias("size"), *words)


def _may_link(a: str, b: str) -> Column:
    """Whether two lines can be similar enough by their maps and sizes (never false where they are) and agree in enough minima."""
    apart = reduce(lambda x, y: x + y, [F.bit_count(F.col(f"w{i}{a}").bitwiseXOR(F.col(f"w{i}{b}"))) for i in range(MAP_WORDS)])
    most = F.lit((1 - SIMILARITY) / (1 + SIMILARITY)) * (F.col(f"size{a}") + F.col(f"size{b}")) + F.lit(1e-6)  # rounding
    return _agree(f"sketch{a}", f"sketch{b}") & (apart <= most)


def _pairs(mixed: DataFrame) -> DataFrame:
    """Pairs of lines of a bucket that are apart. A bucket's lines are dealt over blocks, and each block meets all of them."""
    blocks = F.ceil(F.col("n") / F.lit(PER_TASK)).cast("int")
    left = mixed.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int")).drop("n")
    right = mixed.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).drop("n")
    left, right = [side.select("key", "block", *[F.col(c).alias(c + end) for c in side.columns if c not in ("key", "block")]) for side, end in ((left, "_a"), (right, "_b"))]
    pairs = left.join(right, ["key", "block"]).where("id_a < id_b AND root_a <> root_b").where(_may_link("_a", "_b"))
    return pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()


def _leads(mixed: DataFrame) -> DataFrame:
    """Pairs of lines that are apart with some of their bucket's lines."""
    values = [c for c in mixed.columns if c not in ("key", "n")]
    lead = mixed.groupBy("key", F.pmod(F.xxhash64("id"), F.lit(LEADS)).alias("class")).agg(F.min_by(F.struct(*values), "id").alias("lead"))
    lead = lead.select("key", *[F.col("lead").getField(c).alias(f"{c}_lead") for c in values])
    pairs = mixed.join(lead, "key").where("root <> root_lead").where(_may_link("", "_lead"))
    return pairs.select(F.least("id", "id_lead").alias("a"), F.greatest("id", "id_lead").alias("b")).distinct()


def _found(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """id, line of the wanted ids, each once."""
    wanted = wanted.distinct()
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    return rows.join(wanted, "id", "left_semi").dropDuplicates(["id"])


def _mixed(members: DataFrame, roots: DataFrame, more_than: int, folder: str, name: str) -> DataFrame:
    """key, id, sketch, n, root of the buckets of more lines than that which hold several components."""
    large = members.where(F.col("n") > more_than).select("key", "id", "sketch", "n")
    rooted = large.join(roots, large.id == roots.node, "left").select("key", "id", "sketch", "n", F.coalesce("root", "id").alias("root"))
    rooted = written(rooted, folder, name)
    several = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
    return rooted.join(several, "key", "left_semi")


def line_components(docs: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """The occurrences (doc_id, text_hash, line_no, id) and the line ids that are not their own root (node, root)."""
    rows = lines(docs).withColumn("id", F.xxhash64("line"))
    places = written(rows.select("doc_id", "text_hash", "line_no", "id"), folder, "places")
    rows = rows.select("id", "line")
    keyed = signatures(rows).select("id", _sketch().alias("sketch"), F.explode(_keys()).alias("key")).repartition("key")  # one exchange for the counts and the join
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("lead"), F.min_by("sketch", "id").alias("lead_sketch")).where("n > 1")
    members = written(keyed.join(sizes, "key").select("key", "id", "sketch", "n", "lead", "lead_sketch"), folder, "members")
    led = members.where("id <> lead").where(_agree("sketch", "lead_sketch")).select(F.col("lead").alias("a"), F.col("id").alias("b"))
    done = written(led.distinct(), folder, "pairs-0")
    texts = written(_found(rows, members.select("id")), folder, "texts")
    edges = written(verified(done, texts), folder, "similar-0")
    roots = components(edges, f"{folder}/roots-0")
    members = written(_mixed(members, roots, SMALL_BUCKET, folder, "rooted-0").drop("root"), folder, "apart")
    sized = written(maps(texts.join(members.select("id").distinct(), "id", "left_semi")), folder, "maps")
    for step, least, chosen in ((1, LARGE_BUCKET, _leads), (2, SMALL_BUCKET, _pairs)):
        mixed = _mixed(members, roots, least, folder, f"rooted-{step}").join(sized, "id")
        pairs = written(chosen(mixed).join(done, ["a", "b"], "left_anti"), folder, f"pairs-{step}")
        if pairs.isEmpty():
            continue
        done = done.union(pairs)
        edges = edges.union(written(verified(pairs, texts), folder, f"similar-{step}"))
        roots = components(edges, f"{folder}/roots-{step}")
    for name in ("members", "texts", "apart", "maps", *[f"{n}-{step}" for step in range(3) for n in ("pairs", "rooted", "similar")]):
        drop_folder(docs.sparkSession, f"{folder}/{name}")
    return places, roots


def line_groups(docs: DataFrame, folder: str) -> DataFrame:
    """Every line that is not blank: doc_id, line_no, the first line of its component, and whether it is that line."""
    return _decided(docs, folder).select("doc_id", "line_no", F.col("first.doc_id").alias("first_doc_id"), F.col("first.line_no").alias("first_line_no"), "kept")


def _decided(docs: DataFrame, folder: str) -> DataFrame:
    places, roots = line_components(docs, folder)
    place = F.struct("doc_id", "text_hash", "line_no")
    by_id = places.groupBy("id").agg(F.min(place).alias("first"))
    rooted = by_id.join(roots, by_id.id == roots.node, "left").select("id", "first", F.coalesce("root", "id").alias("root"))
    first = rooted.groupBy("root").agg(F.min("first").alias("first"))
    named = written(rooted.select("id", "root").join(first, "root").select("id", "first"), folder, "named")
    joined = places.select("doc_id", "text_hash", "line_no", "id").join(named, "id")
    return joined.select("doc_id", "text_hash", "line_no", "first", place.eqNullSafe(F.col("first")).alias("kept"))


def deduplicated(docs: DataFrame, folder: str) -> DataFrame:
    """The documents without the lines that repeat an earlier one; n_chars, where there is such a column, follows."""
    gone = _decided(docs, folder).where("not kept").groupBy("doc_id", "text_hash").agg(F.collect_list("line_no").alias("gone"))
    gone = written(gone, folder, "gone")
    names = docs.columns
    rows = docs.select(F.struct(*[docs[c] for c in names]).alias("row"))
    same = F.col("row.doc_id").cast("long").eqNullSafe(gone.doc_id) & (F.xxhash64("row.text") == gone.text_hash)
    joined = rows.join(gone, same, "left").select("row", "gone")
    split = F.split("row.text", "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join(F.transform(left, lambda i: F.get(split, i)), "\n"))
    out = joined.select("row", text.alias("text"))
    changed = {"text": F.col("text"), "n_chars": F.when(F.col("row.text").isNotNull(), F.length("text")).cast("long")}
    return out.select(*[changed[c].alias(c) if c in changed else F.col("row").getField(c).alias(c) for c in names])


def op10_fuzzy_lines(spark: SparkSession, sf: str) -> DataFrame:
    return line_groups(spark.read.parquet(f"{sf}/documents.parquet"), work_folder(spark, "op10"))
