"""Line protocols as tables: texts of replies to rows, one row a line that counts.

Replies are split into lines and read by patterns in the JVM. Where a line's meaning depends on lines before it (claims
of members, repairs of split lines), that dependence is a first-of-key over the exploded lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranking import first_of


def lines(replies: DataFrame, id_col: str, text: str) -> DataFrame:
    """reply, pos (from 0), line (trimmed) of every line that is not blank."""
    d = replies.select(F.col(id_col).alias("reply"), F.posexplode(F.split(F.col(text), r"\r?\n")).alias("pos", "line"))
    return d.withColumn("line", F.trim("line")).where("line <> ''")


def fields(line: Column | str) -> Column:
    """The fields of a line between double semicolons, trimmed."""
    c = F.col(line) if isinstance(line, str) else line
    return F.transform(F.split(c, ";;"), lambda x: F.trim(x))


def verdicts(replies: DataFrame, expected: DataFrame, id_col: str = "reply", text: str = "raw") -> DataFrame:
    """Lines "id;;verdict;;reason" against the expected (reply, id): reply, id, keep, kind, reason, missing.

    Unknown ids and later lines of an id are ignored, as are lines without a reason; a verdict that is not cut, news or opinion, and a missing line, keep
    the item as news.
    """
    d = lines(replies, id_col, text).where(F.col("line").rlike(r"^[0-9]+\s*;;.*?;;.*$"))
    f = fields("line")
    d = d.select("reply", "pos", F.expr("try_cast(regexp_extract(line, '^([0-9]+)', 1) as bigint)").alias("id"), F.lower(f[1]).alias("verdict"), F.array_join(F.slice(f, 3, 1000), ";;").alias("reason")).where("reason <> ''")
    d = first_of(d, [F.col("reply"), F.col("id")], [F.col("pos")])
    j = expected.join(d, ["reply", "id"], "left")
    kind = F.when(F.col("verdict") == "opinion", "opinion").otherwise("news")
    return j.select("reply", "id", F.coalesce(F.col("verdict") != "cut", F.lit(True)).alias("keep"), kind.alias("kind"), F.coalesce("reason", F.lit("no verdict")).alias("reason"), F.col("verdict").isNull().alias("missing"))


def scores(replies: DataFrame, expected: DataFrame, id_col: str = "reply", text: str = "raw", most: int = 50) -> DataFrame:
    """Lines "id;;number;;number;;reason": reply, id, first, second (each between 0 and ``most``), score (their sum). Missing: score 0, both null."""
    d = lines(replies, id_col, text).where(F.col("line").rlike(r"^[0-9]+\s*;;\s*-?[0-9]+\s*;;\s*-?[0-9]+\s*;;"))
    f = fields("line")
    clamp = lambda k: F.greatest(F.lit(0), F.least(F.lit(most), f[k].cast("int")))
    d = d.select("reply", "pos", f[0].cast("bigint").alias("id"), clamp(1).alias("first"), clamp(2).alias("second"))
    d = first_of(d, [F.col("reply"), F.col("id")], [F.col("pos")])
    return expected.join(d, ["reply", "id"], "left").select("reply", "id", "first", "second", F.coalesce(F.col("first") + F.col("second"), F.lit(0)).alias("score"))


def with_second_try(first: DataFrame, second: DataFrame) -> DataFrame:
    """Scores of a first pass, where they are missing those of a second."""
    s = second.where("first is not null").select("reply", "id", F.struct("first", "second", "score").alias("again"))
    pick = lambda c: F.when(F.col("first").isNull() & F.col("again").isNotNull(), F.col(f"again.{c}")).otherwise(F.col(c)).alias(c)
    return first.join(s, ["reply", "id"], "left").select("reply", "id", pick("first"), pick("second"), pick("score"))


def digest(replies: DataFrame, id_col: str = "reply", text: str = "raw") -> DataFrame:
    """Lines "title;;...;;members" cut at the first and the last separator: reply, cluster_index (counting accepted lines from 0), title, members."""
    d = lines(replies, id_col, text).where(F.col("line").rlike(r";;.*;;"))
    d = d.select("reply", "pos", F.trim(F.regexp_extract("line", r"^(.*?);;", 1)).alias("title"), F.trim(F.regexp_extract("line", r"^.*;;(.*)$", 1)).alias("members"))
    d = d.where("title <> '' and members rlike '[0-9]'")
    n = F.row_number().over(Window.partitionBy("reply").orderBy("pos")) - 1
    return d.select("reply", n.alias("cluster_index"), "title", F.transform(F.regexp_extract_all("members", F.lit(r"([0-9]+)"), 1), lambda x: x.cast("bigint")).alias("members"))


def claimed(groups: DataFrame, valid: DataFrame, least: int = 2) -> DataFrame:
    """From (reply, pos, members): reply, pos, member after claims.

    Members that are not valid for the reply (reply, member) or that an earlier group claims are dropped; a group with fewer than ``least`` left is
    dropped, and what it had claimed is free for later groups. Groups only ever lose members to groups that stay, so they are settled
    from the first on, in as many rounds as groups depend on each other.
    """
    from ..runtime import written

    m = groups.select("reply", "pos", F.posexplode("members").alias("at", "member")).join(valid, ["reply", "member"], "left_semi")
    m = written(first_of(m, [F.col("reply"), F.col("pos"), F.col("member")], [F.col("at")]), "claims")
    while True:
        held = m.withColumn("owner", F.min("pos").over(Window.partitionBy("reply", "member")))
        size = held.groupBy("reply", "pos").agg(F.count_if(F.col("owner") == F.col("pos")).alias("n"), F.count_if(F.col("owner") != F.col("pos")).alias("lost"))
        # a small group falls for good once no earlier group that may itself fall holds its members
        small = size.where(F.col("n") < least)
        first_small = small.groupBy("reply").agg(F.min("pos").alias("pos"))
        if first_small.isEmpty():
            return held.where("owner = pos").select("reply", "pos", "member")
        m = written(m.join(first_small, ["reply", "pos"], "left_anti"), "claims")


def split_lines(replies: DataFrame, sizes: DataFrame, id_col: str = "reply", text: str = "raw") -> DataFrame:
    """Lines of numbers, each a group of the items 1..n of its reply (reply, n): reply, pos, member, by the rules of ``claimed``."""
    d = lines(replies, id_col, text)
    g = d.select("reply", "pos", F.transform(F.regexp_extract_all("line", F.lit(r"([0-9]+)"), 1), lambda x: x.cast("bigint")).alias("members")).where(F.size("members") > 0)
    valid = sizes.select("reply", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n").cast("bigint"))).alias("member"))
    return claimed(g, valid)


def attached(replies: DataFrame, sizes: DataFrame, id_col: str = "reply", text: str = "raw") -> DataFrame:
    """Numbers between commas or blanks, in range: reply, member; "none" gives no row."""
    d = replies.select(F.col(id_col).alias("reply"), F.explode(F.split(F.col(text), r"[,\s]+")).alias("x"))
    d = d.select("reply", F.expr("try_cast(regexp_extract(x, '^([0-9]+)', 1) as bigint)").alias("member")).where("member is not null")
    return d.join(sizes, "reply").where("member between 1 and n").select("reply", "member").distinct()


def descriptions(replies: DataFrame, id_col: str = "reply", text: str = "raw") -> DataFrame:
    """Lines "index;;ONE or MULTI;;title;;summary", or three fields, which mean ONE: reply, idx, multi, title, summary; the first line of an index counts."""
    d = lines(replies, id_col, text).where(F.col("line").rlike(r"^[0-9]+\s*;;"))
    f = fields("line")
    d = d.withColumn("f", f).where(F.size("f") >= 3).withColumn("four", F.upper(F.col("f")[1]).isin("ONE", "MULTI") & (F.size("f") >= 4))
    d = d.select("reply", "pos", F.col("f")[0].cast("int").alias("idx"), (F.col("four") & (F.upper(F.col("f")[1]) == "MULTI")).alias("multi"), F.when(F.col("four"), F.col("f")[2]).otherwise(F.col("f")[1]).alias("title"), F.when(F.col("four"), F.array_join(F.slice("f", 4, 1000), ";;")).otherwise(F.array_join(F.slice("f", 3, 1000), ";;")).alias("summary"))
    return first_of(d.where("title <> ''"), [F.col("reply"), F.col("idx")], [F.col("pos")]).drop("pos")


def tie_breaks(replies: DataFrame, id_col: str = "reply", text: str = "raw") -> DataFrame:
    """One reference a line: reply, ref, place of its first occurrence (from 1)."""
    d = lines(replies, id_col, text).select("reply", "pos", F.upper(F.regexp_extract("line", r"(?i)\b([cst][0-9]+)\b", 1)).alias("ref")).where("ref <> ''")
    d = first_of(d, [F.col("reply"), F.col("ref")], [F.col("pos")])
    return d.select("reply", "ref", F.row_number().over(Window.partitionBy("reply").orderBy("pos")).alias("place"))


GRADES = ["development", "minor", "routine", "rerun"]


def grades(replies: DataFrame, id_col: str = "reply", text: str = "raw") -> DataFrame:
    """Lines with a number first and a grade among the other fields, in any order, emphasis tolerated: reply, n, grade. Without a grade, no row."""
    d = lines(replies, id_col, text).select("reply", "pos", F.transform(fields(F.regexp_replace("line", r"[*_`]", "")), F.lower).alias("f"))
    d = d.where(F.col("f")[0].rlike("^[0-9]+$")).select("reply", "pos", F.col("f")[0].cast("int").alias("n"), F.get(F.filter(F.slice("f", 2, 1000), lambda x: x.isin(GRADES)), F.lit(0)).alias("grade"))
    return first_of(d.where("grade is not null"), [F.col("reply"), F.col("n")], [F.col("pos")]).drop("pos")


def confirmed(replies: DataFrame, id_col: str = "reply", text: str = "raw") -> DataFrame:
    """Lines "n;;YES or NO;;reason": reply, n, reason of the last YES; what has none counts as NO and has no row."""
    d = lines(replies, id_col, text)
    f = fields("line")
    d = d.select("reply", "pos", F.when(f[0].rlike("^[0-9]+$"), f[0].cast("int")).alias("n"), F.upper(F.get(f, F.lit(1))).alias("answer"), F.coalesce(F.nullif(F.array_join(F.slice(f, 3, 1000), ";;"), F.lit("")), F.lit("")).alias("reason"))
    return d.where("n is not null and answer = 'YES'").groupBy("reply", "n").agg(F.max_by("reason", "pos").alias("reason"))


def json_lines(replies: DataFrame, id_col: str = "reply", text: str = "raw") -> DataFrame:
    """Lines of JSON with id, title and, or null, body as strings: reply, id, title, body; malformed lines are skipped, the first of an id counts."""
    d = lines(replies, id_col, text).select("reply", "pos", F.from_json("line", "id string, title string, body string").alias("x"))
    d = d.select("reply", "pos", "x.*").where("id is not null and title is not null")
    return first_of(d, [F.col("reply"), F.col("id")], [F.col("pos")]).drop("pos")


def threads(replies: DataFrame, valid: DataFrame, id_col: str = "reply", text: str = "raw") -> DataFrame:
    """Lines "title;;anchor;;summary;;refs": reply, pos, title, summary, member, by the rules of ``claimed`` on references (reply, member)."""
    d = lines(replies, id_col, text).withColumn("f", fields("line")).where(F.size("f") >= 4)
    d = d.select("reply", "pos", F.col("f")[0].alias("title"), F.col("f")[2].alias("summary"), F.transform(F.regexp_extract_all(F.concat_ws(" ", F.col("f")[1], F.element_at("f", -1)), F.lit(r"(?i)\b([cst][0-9]+)\b"), 1), F.upper).alias("members"))
    return claimed(d.select("reply", "pos", "members"), valid).join(d.drop("members"), ["reply", "pos"])
