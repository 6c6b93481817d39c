"""String columns: stripping, slicing, feature text, sections, dates, default tokens."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tutelage.functions.constants import PY_WHITESPACE


def py_strip(col: Column | str) -> Column:
    """``str.strip()``: all Unicode whitespace off both ends (``trim`` would take spaces only)."""
    return F.btrim(_col(col), F.lit(PY_WHITESPACE))


def strip_prompt(generated: Column | str, prompt: Column | str) -> Column:
    """What follows the prompt's length in characters, stripped. By position, not by prefix match."""
    generated, prompt = _col(generated), _col(prompt)
    return py_strip(F.substring(generated, F.length(prompt) + 1, F.length(generated)))


def features_text(spec: Mapping[str, Column]) -> Column:
    """``"Key: value, Key: value"`` in the order of ``spec``; missing values are left out."""
    return F.concat_ws(", ", *[F.concat(F.lit(f"{k}: "), c.cast("string")) for k, c in spec.items()])


def supervised_text(prompt: Column | str, target: Column | str) -> Column:
    """Prompt, blank line, target; null if either is null."""
    return F.concat(_col(prompt), F.lit("\n\n"), _col(target))


def tokens(col: Column | str) -> Column:
    """Default tokens: maximal runs of non-whitespace (ASCII whitespace as in ``\\s``)."""
    return F.filter(F.split(_col(col), r"[ \t\n\r\f]+"), lambda t: t != "")


def token_id(token: Column, vocab_size: int) -> Column:
    """Hashed vocabulary: an id without a dictionary to build, join or broadcast."""
    return (F.conv(F.substring(F.md5(token), 1, 7), 16, 10).cast("long") % F.lit(vocab_size)).cast("int")


def parse_sections(text: Column | str) -> Column:
    """``<PLAN>`` and ``<CODE>`` bodies as a struct; a missing section is null."""
    text = _col(text)

    def body(tag: str) -> Column:
        pattern = rf"(?s)<{tag}>\s*(.*?)\s*</{tag}>"
        return F.when(F.regexp_like(text, F.lit(pattern)), F.regexp_extract(text, pattern, 1))

    return F.struct(body("PLAN").alias("plan"), body("CODE").alias("code"))


def norm_date(col: Column | str) -> Column:
    """ISO, ``dd MMM yyyy`` or US ``MM/dd/yyyy`` to a date; anything else is null."""
    c = py_strip(col)
    formats = {r"\d{4}-\d{2}-\d{2}": "yyyy-MM-dd", r"\d{1,2} [A-Za-z]{3} \d{4}": "d MMM yyyy",
               r"\d{2}/\d{2}/\d{4}": "MM/dd/yyyy"}
    return F.coalesce(*[
        F.when(F.regexp_like(c, F.lit(f"^{shape}$")), F.try_to_date(c, fmt)) for shape, fmt in formats.items()
    ])


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_words(col: Column | str, n: int) -> Column:
    """The first ``n`` words between spaces, tabs and line ends, joined by single spaces."""
    c = F.col(col) if isinstance(col, str) else col
    return F.array_join(F.slice(F.filter(F.split(c, r"[ \t\r\n]+"), lambda w: w != ""), 1, n), " ")
