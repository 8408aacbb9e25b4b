"""Spelling variants by permuterm rotations (operator 11).

Words are counted over all texts. Every word is marked with a terminator and turned through all its
rotations; an edited character is always the last one of some rotation. So words that differ by a
replaced character share a rotation up to its last character, and a word without one of its characters is
that rotation without its last character: replacements and indels both become ranges of sorted rotations
with one prefix that skips the edited character. Sorted by prefix, each range is scanned once: its members
count each other, and each learns the most frequent of the others.

A range holds at most one row per character of the alphabet and one for the shorter word, however often
the words occur, so no range grows with the input. No pairs are emitted: a member needs the range's
counts, its best row and the row after it. Deleting either of two equal neighbouring characters gives the
same word, so only the first character of a run counts as deleted.

Variants lead to forms that are at least `Variants.ratio` times as frequent; chains of forms are followed
by doubling the step, a number of rounds that depends on the logarithm of a chain's length, which itself
is at most the logarithm of the largest count.

Defined results: null, empty and wordless texts have no words; repeated rows count each; a null id counts
as an empty one for the derived typing errors; an empty table gives no rows. Only the columns named as
parameters are read, so others may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .support import crc32_sql, keep

# What a run of letters is, the capitals that are lowered, the divisor of the typing errors.
LOWERED = "[a-zÀ-ÿ]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SLIP = 31

END = "$"  # the terminator: no letter, so it can stand in no word


@dataclass(frozen=True)
class Variants:
    shortest: int = 7  # code points of a word
    rarest: int = 2  # occurrences of a word
    ratio: int = 10  # times that a form occurs more often


def slip_sum(doc_id: Column, run: Column) -> Column:
    return F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))


def slipped(run: Column, checksum: Column) -> Column:
    """The run without the character that the checksum of its document and itself picks, where it does."""
    place = (checksum % F.length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), place), F.substring(run, place + 2, F.length(run)))
    return F.when(checksum % SLIP == 0, shorter).otherwise(run)


def words_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per occurrence of a word in a whole text."""
    text = F.translate(F.col(text_col).cast("string"), CAPITALS, CAPITALS.lower())
    runs = docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(text, F.lit(LOWERED), F.lit(0))).alias("run"))
    summed = runs.select("run", slip_sum(F.col("id"), F.col("run")).alias("checksum"))
    return summed.select(slipped(F.col("run"), F.col("checksum")).alias("word"))


def counted(words: DataFrame, how: Variants = Variants()) -> DataFrame:
    """(word, n) of the words that are long and frequent enough; combined before the shuffle."""
    long_enough = words.where(F.length("word") >= how.shortest)
    return long_enough.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= how.rarest)


def rotations(counts: DataFrame) -> DataFrame:
    """(prefix, last, n): all rotations of the marked words. `last` is the character that the prefix skips;
    it is empty for a whole rotation, which is the prefix of the words that are longer by one character."""
    word = F.col("word")

    def turned(i: Column, skipped: int) -> Column:
        return F.concat(F.substring(word, i + 1 + skipped, F.length(word)), F.lit(END), F.substring(word, F.lit(1), i))

    edited = F.transform(
        F.sequence(F.lit(0), F.length(word) - 1),
        lambda i: F.struct(turned(i, 1).alias("prefix"), F.substring(word, i + 1, F.lit(1)).alias("last")),
    )
    whole = F.transform(
        F.sequence(F.lit(0), F.length(word)),
        lambda i: F.struct(turned(i, 0).alias("prefix"), F.lit("").alias("last")),
    )
    return counts.select(F.inline(F.concat(edited, whole)), "n")


def _word_at(prefix: Column, last: Column) -> Column:
    """The word that a rotation was made from: what follows the terminator, the last character, the rest."""
    place = F.instr(prefix, END)
    return F.concat(F.substring(prefix, place + 1, F.length(prefix)), last, F.substring(prefix, F.lit(1), place - 1))


def neighbours(turned: DataFrame) -> DataFrame:
    """(word, near, best): for each range a word is in with others, how many are near it there, and the
    most frequent of them as (-n, word)."""
    whole = F.col("last") == ""
    # The first of a run of equal characters; the prefix ends with the character before it, or the mark.
    deletable = ~whole & (F.substring("prefix", -1, 1) != F.col("last"))
    range_ = W.partitionBy("prefix")
    # The shorter word first, then the most frequent; equal prefixes order by their last character.
    scan = range_.orderBy(F.col("last") != "", F.col("n").desc(), F.col("last"))
    ranged = turned.select(
        "*",
        F.count(F.lit(1)).over(range_).alias("members"),
        F.max(F.when(whole, F.col("n"))).over(range_).alias("shorter_n"),
        F.count(F.when(deletable, 1)).over(range_).alias("n_longer"),
        F.min(F.when(deletable, F.struct((-F.col("n")).alias("rank"), F.col("last").alias("last")))).over(range_).alias("longer"),
        F.min(F.when(~whole, F.struct((-F.col("n")).alias("rank"), F.col("last").alias("last")))).over(range_).alias("first"),
        F.lead(F.struct((-F.col("n")).alias("rank"), F.col("last").alias("last"))).over(scan).alias("second"),
    ).where("members > 1")
    prefix, last = F.col("prefix"), F.col("last")
    others = F.col("members") - 1 - F.col("shorter_n").isNotNull().cast("long")
    other = F.when(F.col("first.last") == last, F.col("second")).otherwise(F.col("first"))
    replaced = F.when(others > 0, F.struct(other["rank"].alias("rank"), _word_at(prefix, other["last"]).alias("word")))
    deleted = F.when(
        deletable & F.col("shorter_n").isNotNull(),
        F.struct((-F.col("shorter_n")).alias("rank"), _word_at(prefix, F.lit("")).alias("word")),
    )
    inserted = F.when(
        F.col("n_longer") > 0,
        F.struct(F.col("longer.rank").alias("rank"), _word_at(prefix, F.col("longer.last")).alias("word")),
    )
    near = F.when(whole, F.col("n_longer")).otherwise(others + deleted.isNotNull().cast("long"))
    best = F.when(whole, inserted).otherwise(F.least(replaced, deleted))
    found = ranged.select(_word_at(prefix, last).alias("word"), near.alias("near"), best.alias("best"))
    return found.where("near > 0")


def followed(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: forms are followed to the last."""
    reached = keep(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = keep(reached.join(onward, "root", "left").select("word", "root", "next"), "roots")
        reached = step.select("word", F.coalesce("next", "root").alias("root"))
        if step.where("next IS NOT NULL").isEmpty():
            return reached


def variants(counts: DataFrame, how: Variants = Variants()) -> DataFrame:
    """Per word of `counts` (word, n): form, root, n, n_near, form_n. Words are distinct."""
    near = neighbours(rotations(counts))
    none = F.lit(None).cast(near.schema["best"].dataType)
    own = counts.select("word", "n", F.lit(0).cast("long").alias("near"), none.alias("best"))
    met = own.unionByName(near.withColumn("n", F.lit(None).cast("long")))
    words = met.groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min("best").alias("best"))
    leads = -F.col("best.rank") >= how.ratio * F.col("n")
    judged = keep(
        words.select(
            "word", F.when(leads, F.col("best.word")).alias("form"), "n", "n_near", F.when(leads, -F.col("best.rank")).alias("form_n")
        ),
        "variants",
    )
    roots = followed(judged.where("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op11(docs: DataFrame) -> DataFrame:
    counts = keep(counted(words_of(docs, "doc_id", "text")), "words")
    return variants(counts)


_CRC_TABLE, _CRC = crc32_sql("coalesce(doc_id::VARCHAR, '') || ':' || run")

SQL = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(text, '{CAPITALS}', '{CAPITALS.lower()}'), '[a-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents),
slips AS (
    SELECT run, occurrences, {_CRC} AS h
    FROM (SELECT doc_id, run, count(*) AS occurrences FROM runs GROUP BY ALL), crc_table),
typed AS (
    SELECT CASE WHEN h % {SLIP} = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, occurrences
    FROM slips),
words AS (
    SELECT word, sum(occurrences)::BIGINT AS n FROM typed WHERE length(word) >= 7 GROUP BY word HAVING sum(occurrences) >= 2),
-- Every word with one character left out, and where.
shorter AS (
    SELECT word, n, place, word[:place - 1] || word[place + 1:] AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS place FROM words)),
near AS (
    SELECT a.word, b.word AS other, b.n FROM shorter a JOIN shorter b USING (rest, place) WHERE a.word <> b.word
    UNION
    SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON s.rest = w.word
    UNION
    SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON s.rest = w.word),
best AS (
    SELECT w.word, w.n, count(o.other) AS n_near, first(o.other ORDER BY o.n DESC, o.other) AS other,
        max(o.n) AS other_n
    FROM words w LEFT JOIN near o USING (word) GROUP BY w.word, w.n),
judged AS (
    SELECT word, n, n_near, CASE WHEN other_n >= 10 * n THEN other END AS form,
        CASE WHEN other_n >= 10 * n THEN other_n END AS form_n FROM best),
walk AS (
    SELECT word, word AS root FROM judged
    UNION ALL
    SELECT w.word, j.form FROM walk w JOIN judged j ON w.root = j.word WHERE j.form IS NOT NULL)
SELECT j.word, j.form, w.root, j.n, j.n_near, j.form_n
FROM judged j JOIN walk w USING (word) JOIN judged l ON w.root = l.word AND l.form IS NULL
"""
