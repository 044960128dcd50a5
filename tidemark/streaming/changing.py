"""Rules that change while a stream runs.

Rules are a log of versions with their own times.  Rows and rules are merged into one stream and delivered in the order
of their times, so a row meets the version that was valid at its time, whatever the order of arrival.  Rows wait until
the watermark, which is the smaller one of both sides, has passed them: no row is decided before the rules of its time
are known.

A rule table is small against the rows; every version is copied to ``spread`` parts of its code, and the rows of a code
are dealt over these parts, so a frequent code is not one task's state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.streaming.ordered import Rule, apply_rule

RULE, ROW = "0", "1"  # rules go before the rows of the same time, in the order of their texts

MERGED = (("pos", "long"), ("kind", "string"), ("row_id", "long"), ("text", "string"))


class NewestRule(Rule):
    """Give each row the newest text of its code's rules, or its own where there is none yet."""

    fields = MERGED
    memo = (("text", "string"),)
    output = (("row_id", "long"), ("text", "string"), ("ruled", "boolean"))

    def on_event(self, memo, row):
        if row["kind"].startswith(RULE):
            memo["text"] = row["text"]
            return []
        known = memo["text"] is not None
        return [(row["row_id"], memo["text"] if known else row["text"], known)]


class NewestKeyword(Rule):
    """Pass the rows whose text holds the newest keyword, with the keyword."""

    fields = MERGED
    memo = (("keyword", "string"),)
    output = (("row_id", "long"), ("keyword", "string"))

    def __init__(self, initial: str):
        self.initial = initial

    def start(self):
        return {"keyword": self.initial}

    def on_event(self, memo, row):
        if row["kind"].startswith(RULE):
            memo["keyword"] = row["text"]
            return []
        return [(row["row_id"], memo["keyword"])] if row["text"] is not None and memo["keyword"] in row["text"] else []


def _merged(rows: DataFrame, rules: DataFrame, ts: str, code: Column, row_id: str, text: str, spread: int) -> DataFrame:
    columns = [F.col(ts).alias("ts"), F.unix_micros(ts).alias("pos")]
    sides = [
        rows.select(*columns, F.lit(ROW).alias("kind"), F.col(row_id).cast("long").alias("row_id"),
                    F.col(text).cast("string").alias("text"), code.alias("code"),
                    F.pmod(F.xxhash64(row_id), F.lit(spread)).alias("part")),
        rules.select(*columns, F.concat(F.lit(RULE), F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("kind"),
                     F.lit(-1).cast("long").alias("row_id"),
                     F.col("text").cast("string").alias("text"), code.alias("code"),
                     F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spread - 1).cast("long"))).alias("part"))]
    return sides[0].unionByName(sides[1])


def apply_changing_rules(rows: DataFrame, rules: DataFrame, ts: str, code: str, row_id: str, text: str, spread: int = 8) -> DataFrame:
    """``code, row_id, text, ruled``: rows of a watermarked stream with the text of the rule valid at their time.

    ``rules`` is a watermarked stream ``(ts, code, text)`` of versions, ``ts`` named alike on both sides.  Rows without a
    rule keep their own text; a null text ends a code's rule.  Codes may be null, times and row ids may not.
    """
    merged = _merged(rows, rules, ts, F.col(code), row_id, text, spread)
    return apply_rule(merged, ["code", "part"], NewestRule()).select("code", "row_id", "text", "ruled")


def filter_by_newest_keyword(rows: DataFrame, rules: DataFrame, ts: str, row_id: str, text: str, initial: str, spread: int = 8) -> DataFrame:
    """``row_id, keyword``: rows whose text holds the keyword that was newest at their time, at first ``initial``."""
    merged = _merged(rows, rules, ts, F.lit(0), row_id, text, spread)
    return apply_rule(merged, ["code", "part"], NewestKeyword(initial)).select("row_id", "keyword")
