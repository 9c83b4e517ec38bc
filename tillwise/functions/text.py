"""Text columns: title case, stripping, null tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts a CSV reader in pandas takes for a missing value.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# What Python's str.strip() removes; Java's \s alone would miss the no-break and Unicode spaces.
_SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"

# A cased letter in Python's sense. Letters without case (such as CJK) end a word like a digit does.
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"


def null_if_token(col: Column) -> Column:
    """Missing-value tokens become null; only whole, untrimmed cells count as tokens."""
    return F.when(~col.isin(NULL_TOKENS), col)


def strip(col: Column) -> Column:
    return F.regexp_replace(col, f"^{_SPACE}+|{_SPACE}+$", "")


def title_case(col: Column) -> Column:
    """Capitalise every run of letters: ``o'brien 3rd`` gives ``O'Brien 3Rd``.

    ``initcap`` starts a word only after a space, so the text is cut into runs first.
    """
    runs = F.regexp_extract_all(col, F.lit(f"([{_CASED}]+|[^{_CASED}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")
