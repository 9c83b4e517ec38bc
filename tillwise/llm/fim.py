"""Fill-in-middle transformation as a pipeline of Arrow kernels.

A text is cut into units: a word with the blanks before it, or the blanks at its end. Two hashes of the
document's id choose where the prefix and the middle end, two more whether and in which order the parts are
written. Per Arrow batch, without a loop over rows:

1. one regular expression puts a byte behind every unit that no UTF-8 text holds; splitting there gives list arrays;
2. the lists are flattened with the index of their parent, and the ordinal of each unit is its place behind its parent's
   first one;
3. the ordinal beside the two cuts gives the unit's role; units are filtered by role and the lists rebuilt from the
   counts, which follow from the cuts;
4. ``binary_join`` makes each part one string and ``binary_join_element_wise`` puts the parts behind their marks.

``restore`` is the way back, as a column: marks stand in no part, so the text is cut at them.

Defined results: a null text is empty; an empty text is plain and has no unit; a text of blanks is one unit; a text that
holds a mark is plain; a null id hashes like an empty one; rows that repeat an id are cut at the same hashes; a part may
be empty; an empty table gives an empty table; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm.text import small_batches, table

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "42"
CHANGED, SUFFIX_FIRST = 50, 80  # per cent: texts that are changed, and of these those that begin with the suffix
_UNIT = rb"([\x20\t-\r]*[^\x20\t-\r]+|[\x20\t-\r]+)"
_END = b"\xff"
_CUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def hashes(doc_id: Column, seed: str = SEED) -> list[Column]:
    """Four numbers of 32 bits: the leading groups of the id's seeded SHA-256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def _mod(x: pa.Array, y: pa.Array) -> pa.Array:
    return pc.subtract(x, pc.multiply(pc.divide(x, y), y))


def _joined(units: pa.Array, counts: pa.Array) -> pa.Array:
    """One string of every ``counts[i]`` units that follow one another."""
    offsets = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(counts)]).cast(pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, units), b"").cast(pa.string())


def cut_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    """One output row per row of (doc_id, text, h1, h2, changed, suffix_first)."""
    text = pc.fill_null(batch["text"], "")
    lists = pc.split_pattern(pc.replace_substring_regex(text.cast(pa.binary()), _UNIT, b"\\1" + _END), _END)
    parents, units = pc.list_parent_indices(lists), pc.list_flatten(lists)
    # behind the last mark every list has one empty string more
    n = pc.subtract(pc.list_value_length(lists).cast(pa.int64()), 1)
    first = pc.subtract(lists.offsets.cast(pa.int64()), lists.offsets[0].cast(pa.int64()))
    ordinal = pc.subtract(pa.array(range(len(units)), pa.int64()), first.take(parents))
    cuts = [_mod(batch[h], pc.add(n, 1)) for h in ("h1", "h2")]
    low, high = pc.min_element_wise(*cuts), pc.max_element_wise(*cuts)
    in_prefix, before_suffix = pc.less(ordinal, low.take(parents)), pc.less(ordinal, high.take(parents))
    inside = pc.less(ordinal, n.take(parents))
    prefix = _joined(units.filter(in_prefix), low)
    middle = _joined(units.filter(pc.and_not(before_suffix, in_prefix)), pc.subtract(high, low))
    suffix = _joined(units.filter(pc.and_not(inside, before_suffix)), pc.subtract(n, high))
    marked = pc.or_(pc.match_substring(text, PREFIX), pc.match_substring(text, SUFFIX))
    plain = pc.or_(pc.or_(marked, pc.match_substring(text, MIDDLE)), pc.or_(pc.equal(n, 0), pc.invert(batch["changed"])))
    psm = pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, "")
    spm = pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, "")
    kinds = pc.if_else(batch["suffix_first"], "spm", "psm")
    none = pa.scalar(None, pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            batch["doc_id"], n, pc.if_else(plain, "plain", kinds),
            pc.if_else(plain, none, pc.utf8_length(prefix).cast(pa.int64())),
            pc.if_else(plain, none, pc.utf8_length(middle).cast(pa.int64())),
            pc.if_else(plain, text, pc.if_else(batch["suffix_first"], spm, psm)),
        ],
        names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (cut_batch(b) for b in batches if b.num_rows)


def fill_in_middle(docs: DataFrame, seed: str = SEED, changed: int = CHANGED, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and output text of every row of ``docs``.

    ``changed`` per cent of the texts are rearranged, ``suffix_first`` per cent of these with the suffix in front.
    """
    small_batches(docs.sparkSession)
    h1, h2, h3, h4 = hashes(F.col("doc_id"), seed)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", h1.alias("h1"), h2.alias("h2"),
        (h3 % 100 < changed).alias("changed"), (h4 % 100 < suffix_first).alias("suffix_first"),
    )
    return rows.mapInArrow(_cut, _CUT)


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    parts = F.split(output, "<[PSM]>", -1)
    part = lambda i: F.get(parts, F.lit(i))
    psm, spm = F.concat(part(1), part(3), part(2)), F.concat(part(2), part(3), part(1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every document is cut, and digests of its output and of the text rebuilt from it."""
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


SQL = r"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS body, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
    FROM documents),
numbers AS (
    SELECT *, len(units) AS n, CAST('0x' || substr(digest, 1, 8) AS BIGINT) % (len(units) + 1) AS x,
        CAST('0x' || substr(digest, 9, 8) AS BIGINT) % (len(units) + 1) AS y,
        CAST('0x' || substr(digest, 17, 8) AS BIGINT) % 100 AS h3, CAST('0x' || substr(digest, 25, 8) AS BIGINT) % 100 AS h4
    FROM cut),
parts AS (
    SELECT *, array_to_string(units[1:least(x, y)], '') AS prefix,
        array_to_string(units[least(x, y) + 1:greatest(x, y)], '') AS middle,
        array_to_string(units[greatest(x, y) + 1:n], '') AS suffix,
        CASE WHEN n = 0 OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR h3 >= 50 THEN 'plain'
            WHEN h4 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM numbers)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
    CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(body) AS restored_sha256
FROM parts"""
