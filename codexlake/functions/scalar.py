"""Scalar rules of versioned collections as column expressions.

All are null-safe: where a rule says "unknown", the result is null or the stated
default, and nothing raises on bad input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Col = Column | str


def _c(x: Col) -> Column:
    return F.col(x) if isinstance(x, str) else x


def blank_to_null(x: Col) -> Column:
    """Trimmed text, or null if nothing is left."""
    return F.nullif(F.trim(_c(x)), F.lit(""))


# --- dates -----------------------------------------------------------------
def date_safe(x: Col) -> Column:
    """``YYYYMMDD`` or ``Y-M-D`` as a date; anything else, and no real day, is null."""
    t = F.trim(_c(x))
    return F.when(t.rlike(r"^\d{8}$"), F.try_to_date(t, "yyyyMMdd")).when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(t, "yyyy-M-d"))


def date_is_valid(x: Col) -> Column:
    """Blank counts as valid."""
    return blank_to_null(x).isNull() | date_safe(x).isNotNull()


def iso_date(x: Col) -> Column:
    """``YYYY-MM-DD`` or ''."""
    return F.coalesce(F.date_format(date_safe(x), "yyyy-MM-dd"), F.lit(""))


def compact_date(x: Col) -> Column:
    """``YYYYMMDD`` of either form, or ''."""
    return F.coalesce(F.date_format(date_safe(x), "yyyyMMdd"), F.lit(""))


def swiss_date(x: Col) -> Column:
    """``DD.MM.YYYY``, or 'N/A'."""
    return F.coalesce(F.date_format(date_safe(x), "dd.MM.yyyy"), F.lit("N/A"))


def from_swiss_date(x: Col) -> Column:
    """``DD.MM.YYYY`` to ``YYYYMMDD``; '-' and anything else to ''."""
    t = F.trim(_c(x))
    return F.coalesce(F.when(t.rlike(r"^\d{1,2}\.\d{1,2}\.\d{4}$"), F.date_format(F.try_to_date(t, "d.M.yyyy"), "yyyyMMdd")), F.lit(""))


def feed_date(x: Col) -> Column:
    """RFC 822 at midnight UTC."""
    return F.concat(F.date_format(date_safe(x).cast("timestamp"), "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" -0000"))


def date_number(x: Col) -> Column:
    """The digits of an eight-digit date as a number."""
    t = F.trim(_c(x))
    return F.when(t.rlike(r"^\d{8}$"), t.cast("double"))


# --- loose types ------------------------------------------------------------
def bool_safe(x: Col) -> Column:
    """Words for yes and no; '' is no; anything else is null."""
    t = F.lower(F.trim(_c(x)))
    return F.when(t.isin("true", "1", "yes", "on"), True).when(t.isin("false", "0", "no", "off", ""), False)


def float_safe(x: Col) -> Column:
    """A finite number, or null."""
    v = F.trim(_c(x)).try_cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)


def int_safe(x: Col) -> Column:
    """A whole number; a decimal is cut off towards zero."""
    return float_safe(x).try_cast("int")


# --- versions ---------------------------------------------------------------
def version_number(x: Col) -> Column:
    """``066`` is 66; ``066a`` is 66.1: letters count a=1 to z=26, side by side.

    ``066k`` and ``066aa`` are both 66.11; order them by the text as well.
    """
    t = F.trim(_c(x))
    letters = F.transform(F.split(F.regexp_extract(t, r"^\d+([a-z]+)$", 1), ""), lambda c: (F.ascii(c) - 96).cast("string"))
    with_letters = F.concat(F.regexp_extract(t, r"^(\d+)[a-z]+$", 1), F.lit("."), F.array_join(letters, ""))
    return F.when(t.rlike(r"^\d+(\.\d+)?$"), t.cast("double")).when(t.rlike(r"^\d+[a-z]+$"), with_letters.cast("double"))


def natural_key(x: Col, width: int = 20) -> Column:
    """Sort key in which runs of digits compare as numbers and letters without case.

    A run longer than ``width`` keeps its own length, so nothing is cut off.
    """
    runs = F.regexp_extract_all(F.lower(_c(x)), F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.when(r.rlike(r"^\d"), F.when(F.length(r) < width, F.lpad(r, width, "0")).otherwise(r)).otherwise(r)), "")


def suffix_of_link(x: Col) -> Column:
    """What follows the last '-' up to the next '.'; '000' if there is none."""
    return F.coalesce(F.nullif(F.regexp_extract(_c(x), r"-([^-.]*)[^-]*$", 1), F.lit("")), F.lit("000"))


def without_zero_branch(x: Col) -> Column:
    """Number less a leading '0.'."""
    return F.regexp_replace(F.trim(_c(x)), r"^0\.", "")


#: Fixed value: what a collection number consists of.
NUMBER = r"^[0-9.]+$"


# --- hierarchy codes ----------------------------------------------------------
def category_codes(x: Col) -> Column:
    """struct<folder, section, subsection> of a collection number.

    National numbers use one, two and three leading digits of the first group;
    numbers in branch 0 use that branch with them.  A code is null where the number
    is too short, and a level never repeats the one above.  Text of other characters
    than digits and dots has no codes.
    """
    t = F.trim(_c(x))
    t = F.when(t.rlike(NUMBER), t)
    zero = t.startswith("0.")
    group = F.regexp_extract(F.when(zero, F.substring(t, 3, 100)).otherwise(t), r"^(\d+)", 1)
    at = lambda n: F.when(F.length(group) >= n, F.concat(F.when(zero, F.lit("0.")).otherwise(F.lit("")), F.substring(group, 1, n)))
    return F.struct(at(1).alias("folder"), at(2).alias("section"), at(3).alias("subsection"))


# --- URLs, names, references -----------------------------------------------------
def dynamic_url(x: Col) -> Column:
    """A version's page to the same law's ``latest``; other URLs stay."""
    return F.regexp_replace(_c(x), r"(/col-[a-z]+/[^/]+?)-[^-/]+\.html(#.*)?$", "$1/latest$2")


def anchor_parts(x: Col) -> Column:
    """struct<seq int, prov, sub> of ``seq-n-prov-p[-sub-s]``; nulls if it is none."""
    pattern = r"^seq-(\d+)-prov-(\d+[a-z]?)(?:-sub-(\d+))?"
    part = lambda k: F.nullif(F.regexp_extract(_c(x), pattern, k), F.lit(""))
    return F.struct(part(1).cast("int").alias("seq"), part(2).alias("prov"), part(3).alias("sub"))


def provision_input(x: Col) -> Column:
    """struct<prov, sub> of typed input such as ``12a.3``."""
    pattern = r"(?i)^(\d+[a-z]?)(?:\.(\d+))?$"
    part = lambda k: F.nullif(F.regexp_extract(F.trim(_c(x)), pattern, k), F.lit(""))
    return F.struct(F.lower(part(1)).alias("prov"), part(2).alias("sub"))


def reference_label(prov: Col, sub: Col) -> Column:
    """``§ 5 Abs. 2``."""
    return F.concat_ws(" ", F.concat(F.lit("§ "), _c(prov)), F.concat(F.lit("Abs. "), _c(sub)))


def file_parts(x: Col) -> Column:
    """struct<law, version> of ``{law}-{version}.md``, split at the last '-'."""
    pattern = r"^(.*)-([^-]*)\.md$"
    return F.struct(F.regexp_extract(_c(x), pattern, 1).alias("law"), F.regexp_extract(_c(x), pattern, 2).alias("version"))


def xml_escape(x: Col) -> Column:
    out = _c(x)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def feed_guid(date: Col, guid: Col, title: Col) -> Column:
    """Date and guid, or the first 12 hex digits of the title's MD5."""
    return F.concat(_c(date), F.lit("-"), F.coalesce(blank_to_null(guid), F.substring(F.md5(F.coalesce(_c(title), F.lit(""))), 1, 12)))


def squeeze(x: Col) -> Column:
    """White space collapsed and trimmed."""
    return F.trim(F.regexp_replace(_c(x), r"(?U)\s+", " "))


def footnote_text(x: Col) -> Column:
    """Spacing around brackets and punctuation made regular."""
    out = _c(x)
    for pattern, by in ((r"\s+([.,;:!?)\]])", "$1"), (r"([(\[])\s+", "$1"), (r"([.,;:])([^\s\d.,;:)\]])", "$1 $2")):
        out = F.regexp_replace(out, pattern, by)
    return squeeze(out)


def dehyphenate(x: Col) -> Column:
    """``a-  b`` joined between small letters, unless a conjunction follows."""
    return F.regexp_replace(_c(x), r"(\p{Ll})-\s+(?!und\b|oder\b)(\p{Ll})", "$1$2")


#: The words that make a bracket a short title.
ACTS = ("verordnung", "gesetz", "reglement", "konkordat", "abkommen", "vereinbarung", "vertrag", "weisung", "konzession", "ordnung")


def short_title(x: Col) -> Column:
    """struct<short, abbreviation> of the bracket in a title.

    ``(A, B)`` gives both; one part is the short title if it names a kind of act,
    else the abbreviation; a short title without a capital is ''.
    """
    inner = F.regexp_extract(_c(x), r"\(([^)]*)\)", 1)
    first, second = F.trim(F.split(inner, ",", 2)[0]), F.trim(F.try_element_at(F.split(inner, ",", 2), F.lit(2)))
    is_act = F.lower(inner).rlike("|".join(ACTS))
    short = F.when(second.isNotNull(), first).when(is_act, inner).otherwise("")
    return F.struct(
        F.when(short != F.lower(short), short).otherwise("").alias("short"), F.when(second.isNotNull(), second).when(~is_act, inner).otherwise("").alias("abbreviation")
    )


def affair_priority(x: Col, blank: int = 6) -> Column:
    """1 to 4 by the first kind named in a type, 5 for others, ``blank`` for none."""
    t = F.lower(_c(x))
    out = F.when(blank_to_null(x).isNull(), blank)
    for n, word in enumerate(("vorlage", "einzelinitiative", "behördeninitiative", "parlamentarische initiative"), 1):
        out = out.when(t.contains(word), n)
    return out.otherwise(5)


def review_status(status: Col, original: Col, corrected: Col) -> Column:
    """Old and new status words as one of five; unknown words are undefined."""
    s = F.lower(F.trim(F.coalesce(_c(status), F.lit(""))))
    return (
        F.when(s.isin("confirmed_without_changes", "confirmed_with_changes", "rejected", "undefined"), s)
        .when(s == "confirmed", F.when(_c(corrected).isNotNull() & ~_c(original).eqNullSafe(_c(corrected)), "confirmed_with_changes").otherwise("confirmed_without_changes"))
        .when(s == "edited", "confirmed_with_changes")
        .when(s.startswith("merged_with_") | (s == "merged"), "merged")
        .otherwise("undefined")
    )


def json_answer(x: Col) -> Column:
    """The content of the first code fence, else the trimmed text."""
    fenced = F.regexp_extract(_c(x), r"(?s)```(?:json)?\s*(.*?)\s*```", 1)
    return F.when(fenced != "", fenced).otherwise(F.trim(_c(x)))
