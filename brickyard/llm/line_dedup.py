"""Line dedup by a deletion-neighbourhood join, in DataFrame functions only.

A line (text split at newlines) goes if an earlier line of any document (by id, NULL
last, then row, then line number) equals it or is within one character edit (insertion,
deletion or substitution) of it; whether that earlier line stays is not asked. All
lines but empty ones, which part paragraphs, are compared for equality. An edit is
allowed in lines of ``min_edit`` characters or more on both sides: one in fewer is over
an eighth of the line and makes another word or number of it.

Distinct lines are known by 128 hash bits and first place. Emitting every deletion
of every line would cost the square of its length, so two exact filters go first. By
the pigeonhole principle, of lines cut into segments, one edit leaves all but one
segment as they are: only a segment outside which another line is equal can hold the
edit (each line is cut by its own length and by one less, for insertions). The first
filter has 2 segments, the second cuts what is left into 8, and again while a segment
is over ``SEGMENT`` characters, so a very long line is not hashed once for each of its
characters. What remains emits all its deletion variants inside the segment, as hashed keys:

- a line without its character p, with p: lines with equal keys differ in character p
  at most, so all of a group are within one edit of its earliest;
- a line one longer without one character, against the line itself.

So a group needs its earliest members only, never its pairs. Each line meets its
group's earliest, ``levenshtein`` verifies the edit distance, and the earliest stays.

Rows are numbered by their file and place there (by one written copy, if the input isn't a
table of files), so rows that repeat an id or have none are documents of their own, in that order, and no group holds
more than one row's lines. NULL text is empty. A document that loses every line has an
empty text. Empty tables give empty results.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import numbered, small, written

MIN_EDIT = 8
SEGMENT = 256
LONG = 1024
LAST = (1 << 63) - 1
PLACE = ["ord", "row", "at", "h1"]    # a line's place, and its content's hash


def _lines(rows: DataFrame, text: str, least: int) -> DataFrame:
    """(ord, row, at, line, len, h1, h2) of every line of ``least`` or more characters."""
    return (rows.select("ord", "row", F.posexplode(F.split(F.coalesce(F.col(f"own.{text}"), F.lit("")), "\n")).alias("at", "line"))
            .withColumn("len", F.char_length("line")).where(F.col("len") >= least)
            .withColumn("h1", F.xxhash64("line")).withColumn("h2", F.xxhash64(F.lit(1), "line")))


def _cut(df: DataFrame, parts: int) -> DataFrame:
    """Cut each row's segment [b, e) into ``parts``; ``key`` hashes all that lies outside."""
    k = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    return (df.withColumn("k", k).withColumn("b2", F.expr("b + (k * (e - b)) div %d" % parts).cast("int"))
            .withColumn("e", F.expr("b + ((k + 1) * (e - b)) div %d" % parts).cast("int"))
            .withColumn("b", F.col("b2")).drop("b2", "k")
            .withColumn("key", F.expr("xxhash64(len - role, b, e, substring(line, 1, b), substring(line, e + role + 1, len))")))


def _shared(keys: DataFrame) -> DataFrame:
    """Keys that two distinct lines have (partial aggregates first: a hot key is a row a task)."""
    return (keys.groupBy("key").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi"))
            .where("lo < hi").select("key"))


def _within_one() -> Column:
    """Whether ``line`` and ``line_``, which differ, are one edit apart. Spark's bounded
    ``levenshtein`` costs the square of the length, so long lines are compared behind the
    first character that differs, after which one of both or each skips one."""
    alike = F.expr("array_position(zip_with(split(line, ''), split(line_, ''), (x, y) -> x <=> y), false)").cast("int")
    n, m = F.char_length("line"), F.char_length("line_")
    rest = lambda own, at, other, size: F.substring(own, at + F.when(size >= other, 1).otherwise(0), size)
    long = (F.abs(n - m) <= 1) & (rest(F.col("line"), alike, m, n) == rest(F.col("line_"), alike, n, m))
    return F.when(F.greatest(n, m) <= LONG, F.levenshtein("line", "line_", 1).between(0, 1)).otherwise(long)


def near_lines(rows: DataFrame, firsts: DataFrame, *, text: str, min_edit: int) -> DataFrame:
    """The first places of lines that an earlier line is one edit away from."""
    lines = _lines(rows, text, max(1, min_edit))
    roles = lines.withColumn("role", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("b", F.lit(0)).withColumn(
        "e", F.col("len") - F.col("role"))
    halves = _cut(roles, 2).select("key", "h1", "role", "b", "e")
    found = halves.join(_shared(halves), "key").select("h1", "role", "b", "e").distinct()
    found = written(found.join(firsts.select("h1", "ord", "row", "at"), "h1").select(*PLACE, "role", "b", "e"), "line-halves")
    own = written(lines.select(*PLACE, "line", "len").join(
        small(written(found.select(*PLACE).distinct(), "line-found"), 48), PLACE), "line-texts")

    left = found
    while True:
        eighths = _cut(left.join(own, PLACE), 8).select("key", *PLACE, "role", "b", "e")
        left = written(eighths.join(_shared(eighths), "key").select(*PLACE, "role", "b", "e").distinct(), "line-segments")
        if not left.where(F.col("e") - F.col("b") > SEGMENT).limit(1).count():
            break
    held = left.join(own, PLACE)
    spot = (held.where("e + role > b").withColumn("p", F.explode(F.expr("sequence(b + 1, e + role)")))
            .select(*PLACE, F.when(F.col("role") == 0, F.lit("S")).otherwise(F.lit("L")).alias("side"),
                    F.expr("if(role = 0, xxhash64('S', len, p, substring(line, 1, p - 1), substring(line, p + 1, len)), "
                           "xxhash64('D', concat(substring(line, 1, p - 1), substring(line, p + 1, len))))").alias("key")))
    base = held.where("role = 0").select(*PLACE, F.lit("B").alias("side"), F.expr("xxhash64('D', line)").alias("key"))
    variants = written(spot.unionByName(base).distinct(), "line-variants")

    place = F.struct(*PLACE)
    earliest = variants.groupBy("key").agg(
        *[F.min(F.when(F.col("side") == s, place)).alias(s) for s in "SBL"], F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    pairs = (variants.join(earliest, "key")
             .withColumn("by", F.expr("case side when 'S' then S when 'B' then L else B end"))
             .where(F.struct("by.ord", "by.row", "by.at") < F.struct("ord", "row", "at"))
             .select(*PLACE, *[F.col(f"by.{c}").alias(f"{c}_") for c in PLACE]).distinct())
    other = own.select(*[F.col(c).alias(f"{c}_") for c in PLACE], F.col("line").alias("line_"))
    return (pairs.join(own, PLACE).join(other, [f"{c}_" for c in PLACE])
            .where(_within_one()).select(*PLACE).distinct())


def dropped_lines(rows: DataFrame, *, text: str, min_edit: int) -> DataFrame:
    """(row, drops): by row, the dropped lines' numbers."""
    places = written(_lines(rows, text, 1).select("ord", "row", "at", "h1", "h2"), "line-places")
    firsts = written(places.groupBy("h1", "h2").agg(F.min(F.struct("ord", "row", "at")).alias("first"))
                     .select("h1", "h2", "first.*"), "line-firsts")
    near = near_lines(rows, firsts, text=text, min_edit=min_edit).withColumn("near", F.lit(True))
    marks = (firsts.join(near, PLACE, "left")
             .select("h1", "h2", F.col("row").alias("row_"), F.col("at").alias("at_"), F.coalesce("near", F.lit(False)).alias("near")))
    return (places.join(marks, ["h1", "h2"]).where("near OR row <> row_ OR at <> at_")
            .groupBy("row").agg(F.collect_list("at").alias("drops")))


def line_dedup(df: DataFrame, *, text: str = "text", id: str = "doc_id", min_edit: int = MIN_EDIT,
               n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """``df`` with its text free of dropped lines, and the numbers of its lines and of those dropped."""
    order = F.coalesce(F.col(id).cast("long"), F.lit(LAST))
    rows = numbered(df, "row", "line-rows", F.struct("*").alias("own"), order.alias("ord"))
    drops = dropped_lines(rows, text=text, min_edit=min_edit)
    whole = F.coalesce(F.col(f"own.{text}"), F.lit(""))
    joined = rows.select("own", "row").join(drops.hint("shuffle_hash"), "row", "left").withColumn("lines", F.split(whole, "\n"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drops"))       # by hash: linear in the lines
    kept = F.when(F.col("drops").isNull(), F.col("lines")).otherwise(F.transform(stay, lambda i: F.get("lines", i)))
    out = joined.withColumn("kept", kept)
    new = F.when(F.col("drops").isNull(), F.col(f"own.{text}")).otherwise(F.array_join("kept", "\n"))
    return out.select(*[new.alias(c) if c == text else F.col(f"own.{c}").alias(c) for c in df.columns],
                      F.size("lines").alias(n_lines), (F.size("lines") - F.size("kept")).alias(n_dropped))


def line_dedup_query(docs: DataFrame) -> DataFrame:
    out = line_dedup(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE = """
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS k FROM documents),
d AS (SELECT line, length(line) AS n, min((doc_id, k)) AS first FROM l WHERE length(line) >= 1 GROUP BY line),
pair AS (SELECT a.line AS a, b.line AS b, a.n AS an, b.n AS bn, a.first AS af, b.first AS bf
         FROM d a JOIN d b ON left(a.line, 4) = left(b.line, 4) AND a.n >= 8 AND b.n - a.n IN (0, 1) AND a.line <> b.line
         UNION
         SELECT a.line, b.line, a.n, b.n, a.first, b.first
         FROM d a JOIN d b ON right(a.line, 4) = right(b.line, 4) AND a.n >= 8 AND b.n - a.n IN (0, 1) AND a.line <> b.line),
near AS (SELECT * FROM pair WHERE CASE WHEN an = bn
           THEN len(list_filter(range(1, an + 1), lambda i: a[i] <> b[i])) = 1
           ELSE list_contains(list_transform(range(1, bn + 1), lambda i: b[1:i-1] || b[i+1:]), a) END),
gone AS (SELECT a AS line FROM near WHERE bf < af UNION SELECT b FROM near WHERE af < bf),
marked AS (SELECT l.*, length(l.line) >= 1 AND (l.line IN (SELECT line FROM gone) OR (l.doc_id, l.k) <> d.first) AS drop_
           FROM l LEFT JOIN d ON l.line = d.line)
SELECT doc_id, CAST(count(*) AS INTEGER) AS n_lines,
       CAST(count(*) FILTER (WHERE coalesce(drop_, false)) AS INTEGER) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT coalesce(drop_, false)), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
