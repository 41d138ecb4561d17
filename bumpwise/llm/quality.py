"""Line-first cleaning: rules judge each line, failing lines go, and a document that loses too much
of its text is rejected. Native expressions only; one pass over the table, no shuffle.

Line rules (a line without a word is neither judged nor counted):
  punctuation  it is short and does not end in a mark that closes a sentence, or it holds more
               marks of emphasis and symbols than words
  navigation   separators of menus and tables are more than a quarter of its words
  boilerplate  it holds a stock phrase of web pages

Nulls: a null text counts as an empty one; it has no words and is rejected by `base_failed`. Texts
are read whole. Repeated rows are judged one by one. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bumpwise.llm.common import WORD, fresh, table, with_fixed

SPACES = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class LineRules:
    # fixed values
    closing: str = ".!?…。！？:;\"'”’»)]"
    emphasis: str = "!?#*$%&<>"
    separators: str = "|›»•·"
    boilerplate: tuple[str, ...] = (
        "all rights reserved", "click here", "cookie policy", "enable javascript", "lorem ipsum",
        "privacy policy", "skip to content", "subscribe to our newsletter", "terms of service",
        "terms of use",
    )
    separators_per_100_words: int = 25
    emphasis_per_100_words: int = 100
    prose_words: int = 20
    lost_percent: int = 50


def _count(text: Column, characters: str) -> Column:
    """Characters of `text` that are among `characters`, which holds no word character."""
    return F.regexp_count(text, F.lit("[" + "".join(f"\\{c}" for c in characters) + "]"))


def _word_chars(text: Column) -> Column:
    return F.char_length(text) - F.regexp_count(text, F.lit(r"[\x20\x09-\x0D]"))


def _has_stock(text: Column, rules: LineRules) -> Column:
    found = F.lit(False)
    for phrase in rules.boilerplate:
        found = found | F.contains(text, F.lit(phrase))
    return found


def line_fails(line: Column, rules: LineRules, may_hold_stock: Column) -> Column:
    """The cheap tests come first: words are counted only where there is something to compare."""
    words = F.regexp_count(line, F.lit(WORD))
    cut_off = ~F.contains(F.lit(rules.closing), F.right(F.rtrim(line, F.lit(SPACES)), F.lit(1)))
    unclosed = cut_off & (words < rules.prose_words)
    emphasis, separators = _count(line, rules.emphasis), _count(line, rules.separators)
    shouting = (emphasis > 0) & (emphasis * 100 > words * rules.emphasis_per_100_words)
    menu = (separators > 0) & (separators * 100 > words * rules.separators_per_100_words)
    return unclosed | shouting | menu | (may_hold_stock & _has_stock(F.lower(line), rules))


def _repeated_words(hashes: Column, sorted_windows: Column) -> Column:
    """Words inside a 3-word window that occurs again, from the windows sorted by (hash, place)."""
    at = lambda i: F.get(sorted_windows, i)["h"]
    again = F.filter(
        sorted_windows,
        lambda w, i: F.coalesce(w["h"] == at(i + 1), F.lit(False))
        | ((i > 0) & F.coalesce(w["h"] == at(i - 1), F.lit(False))),
    )
    places = F.sort_array(F.transform(again, lambda w: w["i"]))
    start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    covered = F.aggregate(
        places,
        start,
        lambda seen, place: F.struct(
            (seen["n"] + F.least(F.lit(3), place - seen["last"])).alias("n"), place.alias("last")
        ),
        lambda seen: seen["n"],
    )
    return F.when(F.size(hashes) < 3, F.lit(0)).otherwise(covered)


def clean_lines(documents: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """`documents` with `clean_text`, the counts, `base_failed` and `kept`.

    Columns of the input of one of these names are replaced.
    """
    made = (
        "clean_text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "n_lines", "n_lines_removed", "lost_chars", "base_failed", "kept",
    )
    given = [c for c in documents.columns if c.lower() not in made]
    inner = fresh("_q", documents.columns)
    part = lambda name: F.col(f"{inner}_{name}")
    text = F.coalesce(F.col("text"), F.lit(""))
    bad = lambda line: line_fails(line, rules, part("stock"))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    split = with_fixed(
        documents,
        {
            f"{inner}_hashes": F.transform(words, lambda w: F.xxhash64(w)),
            f"{inner}_lines": F.split(text, "\n"),
            f"{inner}_lower": F.lower(text),
        },
    )
    hashes, lines = part("hashes"), part("lines")
    windows = F.transform(
        F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - 2, F.lit(0))),
        lambda h, i: F.struct(F.xxhash64(h, F.get(hashes, i + 1), F.get(hashes, i + 2)).alias("h"), i.alias("i")),
    )
    listed = with_fixed(
        split,
        {
            f"{inner}_windows": F.sort_array(windows),
            f"{inner}_worded": F.filter(lines, lambda line: line.rlike(WORD)),
            f"{inner}_stock": _has_stock(part("lower"), rules),
        },
    )
    listed = with_fixed(listed, {f"{inner}_failed": F.filter(part("worded"), bad)})
    kept_lines = F.filter(
        part("lines"), lambda line: ~line.rlike(WORD) | ~bad(line)
    )
    counted = listed.select(
        *given,
        F.array_join(kept_lines, "\n").alias("clean_text"),
        F.size(part("hashes")).cast("long").alias("n_words"),
        _word_chars(text).cast("long").alias("word_chars"),
        _count(text, "#*$%&|<>").cast("long").alias("n_symbols"),
        (F.size(part("worded")) - F.size(F.array_distinct(part("worded")))).cast("long").alias("n_dup_lines"),
        _repeated_words(part("hashes"), part("windows")).cast("long").alias("n_repeat_words"),
        F.size(part("worded")).cast("long").alias("n_lines"),
        F.size(part("failed")).cast("long").alias("n_lines_removed"),
        _word_chars(F.array_join(part("failed"), "")).cast("long").alias("lost_chars"),
    )
    return counted.withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    ).withColumn(
        "kept", ~F.col("base_failed") & (100 * F.col("lost_chars") <= rules.lost_percent * F.col("word_chars"))
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_lines", "n_lines_removed", "lost_chars",
    )


_RULES = LineRules()
_QUOTED = _RULES.closing.replace("'", "''")


def _sql_count(text: str, characters: str) -> str:
    quoted = characters.replace("'", "''")
    return f"(length({text}) - length(translate({text}, '{quoted}', '')))"


OP8_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
w AS (
  SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS worded
  FROM d),
windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, words[i], words[i + 1], words[i + 2]) AS n
  FROM (SELECT r, words, unnest(generate_series(1, len(words) - 2)) AS i FROM w)),
repeated AS (
  SELECT r, count(*) AS n FROM (
    SELECT DISTINCT r, i + k AS i FROM windows, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1)
  GROUP BY r),
failed AS (
  SELECT r, count(*) AS n, sum(chars) AS chars FROM (
    SELECT r, length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g')) AS chars, line,
      len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n_words
    FROM (SELECT r, unnest(worded) AS line FROM w))
  WHERE n_words < {_RULES.prose_words}
      AND NOT contains('{_QUOTED}', right(regexp_replace(line, '[\\x20\\x09-\\x0D]+$', ''), 1))
    OR {_sql_count("line", _RULES.emphasis)} * 100 > n_words * {_RULES.emphasis_per_100_words}
    OR {_sql_count("line", _RULES.separators)} * 100 > n_words * {_RULES.separators_per_100_words}
    OR regexp_matches(lower(line), '{"|".join(_RULES.boilerplate)}')
  GROUP BY r),
counted AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
    length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
    {_sql_count("text", "#*$%&|<>")}::BIGINT AS n_symbols,
    (len(worded) - len(list_distinct(worded)))::BIGINT AS n_dup_lines,
    coalesce(repeated.n, 0)::BIGINT AS n_repeat_words, len(worded)::BIGINT AS n_lines,
    coalesce(failed.n, 0)::BIGINT AS n_lines_removed, coalesce(failed.chars, 0)::BIGINT AS lost_chars
  FROM w LEFT JOIN repeated USING (r) LEFT JOIN failed USING (r))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND 100 * lost_chars <= {_RULES.lost_percent} * word_chars AS kept
FROM counted
"""
