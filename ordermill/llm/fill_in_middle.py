"""Fill-in-the-middle: documents cut into prefix, middle and suffix and put together in another order.

The cut is one regular expression match for each row: a pattern with counted, possessive groups of the row's own
lengths, ``(.{a}+)(.{b}+)(.*+)``, takes the three pieces at once and never goes back. Units are code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The sentinels and shares of the contract.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CUT_PERCENT = 90
SUFFIX_FIRST_PERCENT = 20
SEED = "1"
#: Code points counted as one match, so that counting a long text makes no object for each of them.
STRIDE = 4096


def length(text: Column) -> Column:
    """Code points of a text: whole strides first, then those of the rest."""
    stride = F.lit(f"(?s).{{{STRIDE}}}+")
    rest = F.regexp_replace(text, stride, F.lit(""))
    return F.regexp_count(text, stride).cast("bigint") * STRIDE + F.regexp_count(rest, F.lit("(?s)."))


def draws(doc_id: Column, seed: str = SEED) -> list[Column]:
    """Four numbers under 2^32 that depend on the seed and the id alone; a null id is the text ``null``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("bigint") for k in range(4)]


def fill_in_middle(
    docs: DataFrame, cut_percent: int = CUT_PERCENT, suffix_first_percent: int = SUFFIX_FIRST_PERCENT, seed: str = SEED
) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): ``doc_id, n, form, prefix_chars, middle_chars, output``.

    ``n`` is the number of code points. Of 100 documents ``cut_percent`` are cut, at two places drawn from the id;
    the form ``psm`` is prefix, suffix, middle, and ``spm`` (``suffix_first_percent`` of the cut ones) suffix, prefix,
    middle, each behind its sentinel. The others, empty texts and texts that hold a sentinel stay as they are, in the
    form ``plain``, without lengths. A null text is empty. A null id draws like the text ``null``; rows of one id
    draw alike. Texts of any length are matched whole, without recursion. An empty table gives no rows; other columns
    are not looked at.
    """
    counted = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("n", length(F.col("text")))
    one, two, three, four = draws(F.col("doc_id"), seed)
    first, second = one % (F.col("n") + 1), two % (F.col("n") + 1)
    held = [F.contains("text", F.lit(mark)) for mark in (PREFIX, SUFFIX, MIDDLE)]
    plain = (F.col("n") == 0) | held[0] | held[1] | held[2] | (three % 100 >= cut_percent)
    cut = counted.withColumn("form", F.when(plain, "plain").when(four % 100 < suffix_first_percent, "spm").otherwise("psm"))
    whole = F.col("form") == "plain"
    cut = cut.withColumn("prefix_chars", F.when(~whole, F.least(first, second)))
    cut = cut.withColumn("middle_chars", F.when(~whole, F.greatest(first, second) - F.col("prefix_chars")))
    pattern = F.concat(F.lit("(?s)^(.{"), F.col("prefix_chars"), F.lit("}+)(.{"), F.col("middle_chars"), F.lit("}+)(.*+)"))
    order = F.when(F.col("form") == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    output = F.when(whole, F.col("text")).otherwise(F.regexp_replace("text", pattern, order))
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of.

    A cut text holds no sentinel, and none can arise where a piece meets one, so the first of each kind is the one put in.
    """
    psm = F.regexp_replace(output, F.lit(f"(?s)^{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*+)"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(f"(?s)^{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*+)"), F.lit("$2$3$1"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def cut_report(docs: DataFrame) -> DataFrame:
    """``fill_in_middle`` with digests of the output and of the text rebuilt from it, in place of the output."""
    cut = fill_in_middle(docs)
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return cut.select(
        *[c for c in cut.columns if c != "output"],
        digest(F.col("output")).alias("output_sha256"),
        digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


ORACLE = """
with d as (
  select doc_id, coalesce(text, '') as text, length(coalesce(text, ''))::bigint as n,
    sha256('1:' || coalesce(doc_id::varchar, 'null')) as h from documents),
drawn as (
  select *, ('0x' || h[1:8])::bigint % (n + 1) as u, ('0x' || h[9:16])::bigint % (n + 1) as v,
    case when n = 0 or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
        or ('0x' || h[17:24])::bigint % 100 >= 90 then 'plain'
      when ('0x' || h[25:32])::bigint % 100 < 20 then 'spm' else 'psm' end as form from d),
cut as (
  select *, least(u, v) as a, greatest(u, v) - least(u, v) as b from drawn),
pieces as (
  select *, substring(text, 1, a) as p, substring(text, a + 1, b) as m, substring(text, a + b + 1) as s from cut)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then concat('<P>', p, '<S>', s, '<M>', m)
    else concat('<S>', s, '<P>', p, '<M>', m) end) as output_sha256,
  sha256(text) as restored_sha256
from pieces"""
