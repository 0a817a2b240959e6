"""Jobs that keep personal data out of what is stored or shared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as S


def pseudonym(user: Column, bot: Column, salt: str) -> Column:
    """A stable name that doesn't tell whose it is: Bot- or Editor- and 10 digits of a salted hash. A temporary account gets the
    form of one, with 128 bits of the hash as its numbers, so that no two of any number of accounts share a name."""
    hashed = F.sha2(F.concat(F.lit(salt), user), 256)
    number = lambda first: F.lpad(F.conv(F.substring(hashed, first, 16), 16, 10), 20, "0")
    prefix = F.when(F.coalesce(bot, F.lit(False)), "Bot-").otherwise("Editor-")
    return F.when(user.rlike(S.TEMPORARY_ACCOUNT), F.concat(F.lit("~2000-"), number(1), F.lit("-"), number(17))).when(user.isNotNull(), F.concat(prefix, F.substring(hashed, 1, 10)))


def pseudonymised(rows: DataFrame, watchlist: DataFrame, salt: str) -> DataFrame:
    """Typed rows without watched pages, with pseudonyms in place of names. Rows in which an IP is left go."""
    out = rows.join(watchlist.select("wiki", "title"), ["wiki", "title"], "left_anti").withColumn("user_name", pseudonym(F.col("user_name"), F.col("is_bot"), salt))
    return out.where(~F.coalesce(S.contains_ip(F.col("title")), F.lit(False)) & ~F.coalesce(S.contains_ip(F.col("user_name")), F.lit(False)))


def lines_with_ip(texts: DataFrame, column: str = "text") -> DataFrame:
    """id, line number and line of each line of the texts that holds an IP-like token."""
    lines = texts.select("doc_id", F.posexplode(F.split(column, "\n")).alias("line_no", "line"))
    return lines.where(S.contains_ip(F.col("line")))
