"""Rules of published pages as column expressions: names, links, tables, texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from codexlake.functions.scalar import Col, _c, blank_to_null, swiss_date


def html_escape(x: Col) -> Column:
    """Text for HTML, quotes of both kinds included."""
    out = _c(x)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def numbered_name(x: Col) -> Column:
    """struct<stem, number> of a page's name: the digits behind its last ``-digits``; nulls if none."""
    name = F.replace(_c(x), F.lit(".html"), F.lit(""))
    part = lambda n: F.nullif(F.regexp_extract(name, r"^(.+)-(\d+)", n), F.lit(""))
    return F.struct(part(1).alias("stem"), part(2).cast("int").alias("number"))


def first_containing(x: Col, rules: list[tuple[str, str]], default: str) -> Column:
    """The value of the first rule whose text is in ``x``."""
    out = F.lit(default)
    for part, value in reversed(rules):
        out = F.when(_c(x).contains(part), value).otherwise(out)
    return out


def page_meta(file: Col, title: Col, special: dict[str, str], language: str = "de-CH") -> Column:
    """struct<language, description>: a page's own text by file name, else its title."""
    text = F.coalesce(_c(title), F.lit(""))
    for name, description in special.items():
        text = F.when(_c(file) == name, description).otherwise(text)
    return F.struct(F.lit(language).alias("language"), text.alias("description"))


def content_hash(content: Col) -> Column:
    """The first eight hex digits of the MD5 of a file's bytes or a text."""
    return F.substring(F.md5(_c(content)), 1, 8)


def versioned_name(path: Col, digest: Col) -> Column:
    """``dir/name.ext`` with ``.v{digest}`` before its last extension."""
    name = F.regexp_extract(_c(path), r"([^/]*)$", 1)
    stem, suffix = F.regexp_extract(name, r"^(.+?)(\.[^.]*)?$", 1), F.regexp_extract(name, r"^.+?(\.[^.]*)$", 1)
    return F.concat(F.regexp_extract(_c(path), r"^(.*/)?[^/]*$", 1), stem, F.lit(".v"), _c(digest), suffix)


#: Fixed value: an import of a style sheet.
IMPORT = r"""@import\s+(?:url\()?['"]([^'"]+\.css)['"](?:\))?"""


def imports_of(x: Col) -> Column:
    """The style sheets that a style sheet imports, as they are keyed."""
    return F.transform(F.regexp_extract_all(_c(x), F.lit(IMPORT), F.lit(1)), lambda p: F.regexp_replace(p, r"^[./]+", ""))


def rewrite_imports(x: Col, names: Col) -> Column:
    """struct<content, missing>: imports by the map ``names``; what it lacks stays and is listed."""
    whole = F.regexp_extract_all(_c(x), F.lit(IMPORT), F.lit(0))
    keys, gaps = imports_of(x), F.split(_c(x), IMPORT)
    name = lambda k: F.try_element_at(_c(names), k)
    new = F.zip_with(whole, keys, lambda w, k: F.when(name(k).isNull(), w).when(w.contains("url("), F.concat(F.lit("@import url('"), name(k), F.lit("')"))).otherwise(F.concat(F.lit("@import '"), name(k), F.lit("'"))))
    content = F.array_join(F.zip_with(gaps, new, lambda g, n: F.concat(g, F.coalesce(n, F.lit("")))), "")
    return F.struct(content.alias("content"), F.filter(keys, lambda k: name(k).isNull()).alias("missing"))


def size_saving(before: Col, after: Col) -> Column:
    """struct<saved, percent> of a file made smaller."""
    saved = _c(before) - _c(after)
    return F.struct(saved.alias("saved"), F.coalesce(F.round(F.try_divide(saved * 100, _c(before)), 2), F.lit(0.0)).alias("percent"))


def is_abbreviation(content: Col, term: Col) -> Column:
    """Whether a page states ``term`` as its abbreviation."""
    found = F.regexp_extract(_c(content), r'Abkürzung:</div><div[^>]*data-pagefind-weight="10"[^>]*>([^<]+)</div>', 1)
    return (found != "") & (F.lower(F.trim(found)) == _c(term))


def affair_table(title: Col, kind: Col, number: Col, affair: Col, steps: Col, changes: Col, pdf: Col, page: Col) -> Column:
    """An affair as an HTML table: what it has of kind, numbers, steps, changes and links.

    ``steps`` is array<struct<date, type>>, ``changes`` map<law, array<norm>>; norms are
    shown without section signs and dots.
    """
    line = lambda name, value: F.concat(F.lit(f"<tr><td>{name}:</td><td>"), value, F.lit("</td></tr>"))
    optional = lambda name, x: F.coalesce(line(name, html_escape(blank_to_null(x))), F.lit(""))
    dated = F.array_join(F.transform(_c(steps), lambda s: F.concat(swiss_date(s["date"]), F.lit(": "), html_escape(s["type"]))), "<br>")
    bare = lambda n: html_escape(F.trim(F.regexp_replace(n, r"[§.]", "")))
    named = F.array_join(F.transform(F.map_entries(_c(changes)), lambda e: F.concat(html_escape(e["key"]), F.lit(": "), F.array_join(F.transform(e["value"], bare), ", "))), "<br>")
    link = lambda x, name: F.concat(F.lit("<a href='"), html_escape(blank_to_null(x)), F.lit(f"'>{name}</a>"))
    links = F.array_join(F.filter(F.array(link(pdf, "PDF"), link(page, "Geschäft")), lambda x: x.isNotNull()), "<br>")
    return F.concat(
        F.lit("<h3>"), html_escape(title), F.lit("</h3><table border='1' cellpadding='5' style='border-collapse: collapse;'>"),
        optional("Geschäftsart", kind), optional("Vorlagen-Nr", number), optional("KR-Nr", affair),
        F.when(F.size(_c(steps)) > 0, line("Ablaufschritte", dated)).otherwise(""), F.when(F.size(_c(changes)) > 0, line("Änderungen (KI)", named)).otherwise(""),
        F.when(links != "", line("Hyperlinks", links)).otherwise(""), F.lit("</table>"),
    )


def links_block(base: str, title: Col, fixed: Col, moving: Col, source: Col) -> Column:
    """The links of a page to copy: to this version, to the latest one, to the source if known."""

    def group(name: str, url: Column) -> Column:
        return F.concat(F.lit(f'<div class="link-group"><div class="link-title">{name}</div><div class="link-url-container"><div class="link-url">'), url, F.lit("</div></div></div>"))

    head = F.coalesce(F.concat(F.lit('<div class="link-group"><div class="link-title">'), html_escape(blank_to_null(title)), F.lit('</div></div><hr class="links-separator">')), F.lit(""))
    return F.concat(
        F.lit('<div class="links-container"><div class="links-inner">'), head, group("Zu dieser Version:", F.concat(F.lit(base), _c(fixed))), group("Zur jeweils neusten Version:", F.concat(F.lit(base), _c(moving))),
        F.coalesce(group("Quelle:", blank_to_null(source)), F.lit("")), F.lit("</div></div>"),
    )


def box_edges(chars: Col, box: Col) -> Column:
    """struct<left, top, right, bottom>: of the first and last character's boxes, else the element's, else 0."""
    has = F.size(F.coalesce(_c(chars), F.array())) > 0
    at = lambda n: F.coalesce(F.when(has, F.try_element_at(_c(chars), F.lit(1 if n < 2 else -1))[n]), F.when(~has, F.try_element_at(_c(box), F.lit(n + 1))), F.lit(0.0))
    return F.struct(at(0).alias("left"), at(1).alias("top"), at(2).alias("right"), at(3).alias("bottom"))


def number_or_zero(x: Col) -> Column:
    """A position attribute: 0 if it is missing or empty, null if it is no number."""
    return F.when(blank_to_null(x).isNull(), 0.0).otherwise(F.trim(_c(x)).try_cast("double"))


def element_id(*parts: Col) -> Column:
    """Twenty digits for an element, the same each time."""
    digest = F.sha2(F.concat_ws("/", *(_c(p).cast("string") for p in parts)), 256)
    half = lambda n: F.lpad(F.pmod(F.conv(F.substring(digest, n, 12), 16, 10).cast("long"), F.lit(10**10)).cast("string"), 10, "0")
    return F.concat(half(1), half(13))


def link_text(x: Col) -> Column:
    """A link's text without brackets, semicolons and its last dot; null without a digit."""
    first = F.trim(F.split(_c(x), "\n")[0])
    return F.when(first.rlike(r"\d"), F.regexp_replace(F.trim(F.regexp_replace(first, r"[();]", "")), r"\.$", ""))


def law_path(base: str, law: Col, date: Col, kind: str) -> Column:
    """Where a version's file of a kind lies."""
    suffix = {"raw": "-raw.html", "metadata": "-metadata.json", "pdf": ".pdf"}[kind]
    return F.concat(F.lit(base.rstrip("/") + "/"), _c(law), F.lit("/"), _c(date), F.lit("/"), _c(law), F.lit("-"), _c(date), F.lit(suffix))


def sibling_paths(path: Col, suffix: str, others: dict[str, str]) -> Column:
    """struct of a path's siblings: its suffix replaced by each of ``others``."""
    stem = F.when(_c(path).endswith(suffix), F.substring(_c(path), F.lit(1), F.length(_c(path)) - len(suffix))).otherwise(_c(path))
    return F.struct(*(F.concat(stem, F.lit(s)).alias(n) for n, s in others.items()))


def source_url(page: Col, text: Col) -> Column:
    """A law's page, or else its text's address; '' if neither."""
    return F.coalesce(blank_to_null(page), blank_to_null(text), F.lit(""))


def is_number(x: Col) -> Column:
    """Digits and dots only."""
    return F.coalesce(_c(x).rlike(r"^[0-9.]+$"), F.lit(False))


def is_date_folder(x: Col) -> Column:
    """Eight digits."""
    return F.coalesce(_c(x).rlike(r"^\d{8}$"), F.lit(False))


def is_repealed(x: Col) -> Column:
    """Whether there is a repeal date."""
    return blank_to_null(x).isNotNull()


def is_international(x: Col) -> Column:
    """Numbers of branch 0."""
    return F.coalesce(_c(x).startswith("0."), F.lit(False))


def without_dashes(kind, x: Column) -> Column:
    """A value of any type whose strings ``-`` are '' instead, at every depth; ``kind`` is its type."""
    from pyspark.sql import types as T

    if isinstance(kind, T.StringType):
        return F.when(x == "-", "").otherwise(x)
    if isinstance(kind, T.StructType):
        return F.when(x.isNotNull(), F.struct(*(without_dashes(f.dataType, x[f.name]).alias(f.name) for f in kind.fields)))
    if isinstance(kind, T.ArrayType):
        return F.transform(x, lambda y: without_dashes(kind.elementType, y))
    if isinstance(kind, T.MapType):
        return F.transform_values(x, lambda _, y: without_dashes(kind.valueType, y))
    return x


def is_metadata(x: Col) -> Column:
    """Whether a JSON text is a version's metadata: an object with both its parts as objects."""
    part = lambda name: F.coalesce(F.get_json_object(_c(x), f"$.{name}").startswith("{"), F.lit(False))
    return part("doc_info") & part("process_steps")


#: The fields of a law's panel, in order, and those that are dates.
PANEL = (
    ("kurztitel", "Kurztitel"), ("abkuerzung", "Abkürzung"), ("ordnungsnummer", "Ordnungsnummer"), ("nachtragsnummer", "Nachtragsnummer"), ("erlassdatum", "Erlassdatum"),
    ("inkraftsetzungsdatum", "Inkraftsetzungsdatum"), ("publikationsdatum", "Publikationsdatum"), ("aufhebungsdatum", "Aufhebungsdatum"),
)
_WEIGHTED, _META = ("abkuerzung",), ("ordnungsnummer", "nachtragsnummer")


def panel(info: Col, in_force: Col, collection: Col) -> Column:
    """struct<status, facet, html> of a version: what the page says of it, the search facet, and its panel.

    ``info`` is a struct with the fields of ``PANEL`` and ``erlasstitel``; what is missing is N/A.
    """
    item = lambda label, value, more="", kind="row": F.concat(F.lit(f'<div class="metadata-item metadata-item-{kind}"><div class="metadata-label">{label}:</div><div class="metadata-value"{more}>'), value, F.lit("</div></div>"))
    text = lambda name: F.coalesce(html_escape(blank_to_null(_c(info)[name])), F.lit("N/A"))
    rows = []
    for name, label in PANEL:
        more = ' data-pagefind-weight="10"' if name in _WEIGHTED else f' data-pagefind-meta="{label}"' if name in _META else ""
        rows.append(item(label, swiss_date(_c(info)[name]) if name.endswith("datum") else text(name), more))
    named = blank_to_null(collection)
    origin = F.when(named.isNull(), item("Gesetzessammlung", F.lit("N/A"))).otherwise(item("Gesetzessammlung", html_escape(named), ' data-pagefind-meta="Gesetzessammlung" data-pagefind-filter="Gesetzessammlung"'))
    title = item("Erlasstitel", text("erlasstitel"), ' data-pagefind-weight="10"', "full")
    html = F.concat(F.lit('<details id="doc-info"><summary>Basisinformationen</summary><div class="metadata-content">'), title, *rows, origin, F.lit("</div></details>"))
    number = F.concat(F.lit("("), _c(info)["ordnungsnummer"], F.lit("-"), _c(info)["nachtragsnummer"], F.lit(")"))
    status = F.concat(F.when(_c(in_force), "Text in Kraft ").otherwise("Text nicht in Kraft "), number)
    return F.struct(status.alias("status"), F.concat(F.lit("Text in Kraft:"), F.when(_c(in_force), "Ja").otherwise("Nein")).alias("facet"), html.alias("html"))


def law_container(base: str, collection: Col, law: Col, version: Col, newest: Col, title: Col, body: Col) -> Column:
    """struct<canonical, html> of a version's page: its canonical address is the newest version's, and only that one is indexed."""
    last = F.coalesce(_c(newest), _c(version))
    canonical = F.concat(F.lit(base), F.lit("/col-"), _c(collection), F.lit("/"), _c(law), F.lit("-"), last, F.lit(".html"))
    index = F.when(last == _c(version), " data-pagefind-body").otherwise("")
    attributes = F.concat(F.lit(' data-ordnungsnummer="'), html_escape(law), F.lit('" data-nachtragsnummer="'), html_escape(version), F.lit('" data-title="'), html_escape(title), F.lit('"'))
    head = F.concat(F.lit('<head><link rel="canonical" href="'), canonical, F.lit('"></head>'))
    return F.struct(canonical.alias("canonical"), F.concat(F.lit("<html>"), head, F.lit('<body><div id="law"'), attributes, index, F.lit(">"), F.coalesce(_c(body), F.lit("")), F.lit("</div></body></html>")).alias("html"))


def modern_page(x: Col) -> Column:
    """An old page without scripts, fonts, italics, bold and body attributes, its content in the law's containers."""
    out = F.regexp_replace(F.coalesce(_c(x), F.lit("")), r"(?is)<script\b.*?</script\s*>", "")
    out = F.regexp_replace(out, r"(?is)<!doctype[^>]*>\s*", "")
    # Large type is a heading of its text alone.
    large = r"""(?is)<font\b[^>]*\bsize\s*=\s*["']?5["']?[^>]*>(.*?)</font\s*>"""
    parts, heads = F.split(out, large), F.regexp_extract_all(out, F.lit(large), F.lit(1))
    titled = F.transform(heads, lambda h: F.concat(F.lit("<h1>"), F.regexp_replace(h, r"<[^>]*>", ""), F.lit("</h1>")))
    out = F.array_join(F.zip_with(parts, titled, lambda p, h: F.concat(p, F.coalesce(h, F.lit("")))), "")
    out = F.regexp_replace(out, r"(?i)</?(?:font|i|b)\b[^>]*>", "")
    body = F.trim(F.regexp_extract(out, r"(?is)<body\b[^>]*>(.*)</body\s*>", 1), F.lit(" \n\r\t"))
    made = F.concat(F.lit('<body><div id="law"><div id="source-text" class="html-source">'), body, F.lit("</div></div></body>"))
    before, after = F.regexp_extract(out, r"(?is)^(.*?)<body\b", 1), F.regexp_extract(out, r"(?is)</body\s*>(.*)$", 1)
    return F.when(out.rlike(r"(?i)<body\b"), F.concat(before, made, after)).otherwise(out)
