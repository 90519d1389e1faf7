"""HTML documents: text, links, tags, Markdown, cleaning and differences.

Each is one pass of the standard parser over Arrow batches; documents are
independent, so a job is one scan with no shuffle.
"""

from __future__ import annotations

import bisect
import difflib
import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexlake.session import ship

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
HIDDEN = {"script", "style", "template", "noscript", "title"}
BLOCK = {"p", "div", "li", "ul", "ol", "table", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "article", "section", "nav", "footer", "header", "br", "hr", "body", "main", "blockquote", "dl", "dt", "dd"}
#: Attributes that cleaning removes.
UNWANTED = {"style", "bgcolor", "width", "height", "align", "valign", "border", "cellpadding", "cellspacing", "onclick", "onload", "onmouseover", "lang"}


class _Walk(HTMLParser):
    """Feeds text outside hidden elements, and tags, to the methods below."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.hidden = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in HIDDEN:
            self.hidden += 1
        elif not self.hidden:
            self.opened(tag, {k: v or "" for k, v in attrs})

    def handle_endtag(self, tag: str) -> None:
        if tag in HIDDEN:
            self.hidden = max(0, self.hidden - 1)
        elif not self.hidden:
            self.closed(tag)

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.said(data)

    def opened(self, tag: str, attrs: dict[str, str]) -> None: ...
    def closed(self, tag: str) -> None: ...
    def said(self, data: str) -> None: ...


def _run(walk: _Walk, html: str | None) -> _Walk:
    walk.feed(html or "")
    walk.close()
    return walk


class _Text(_Walk):
    def __init__(self) -> None:
        super().__init__()
        self.parts: list[str] = []

    def opened(self, tag: str, attrs: dict[str, str]) -> None:
        if tag in BLOCK:
            self.parts.append(" ")

    closed = lambda self, tag: self.opened(tag, {})

    def said(self, data: str) -> None:
        self.parts.append(data)


def text_of(html: str | None) -> str:
    """Visible text with single spaces."""
    return " ".join("".join(_run(_Text(), html).parts).split())


class _Links(_Walk):
    def __init__(self) -> None:
        super().__init__()
        self.out: list[list[str]] = []
        self.open: list[int] = []

    def opened(self, tag: str, attrs: dict[str, str]) -> None:
        if tag == "a" and attrs.get("href"):
            self.out.append([attrs["href"], ""])
            self.open.append(len(self.out) - 1)

    def closed(self, tag: str) -> None:
        if tag == "a" and self.open:
            self.open.pop()

    def said(self, data: str) -> None:
        for k in self.open[-1:]:
            self.out[k][1] += data


def links_of(html: str | None) -> list[tuple[str, str]]:
    """(href, text) in document order."""
    return [(h, " ".join(t.split())) for h, t in _run(_Links(), html).out]


class _Tags(_Walk):
    def __init__(self) -> None:
        super().__init__()
        self.counts: dict[str, int] = {}

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.counts[tag] = self.counts.get(tag, 0) + 1
        super().handle_starttag(tag, attrs)


class _Markdown(_Walk):
    """Headings at most five deep, provisions bracketed, margin notes as level six."""

    def __init__(self, base: str) -> None:
        super().__init__()
        self.base, self.lines, self.line, self.prefix, self.link, self.skip = base, [], [], "", None, 0
        self.stack: list[str] = []

    def flush(self) -> None:
        body = re.sub(r"\s+", " ", "".join(self.line)).strip()
        if body:
            self.lines += [self.prefix + body, ""]
        self.line, self.prefix = [], ""

    def opened(self, tag: str, attrs: dict[str, str]) -> None:
        kinds = attrs.get("class", "").split()
        if tag not in VOID and (self.skip or tag in ("nav", "footer") or "footnote" in kinds or "annex" in kinds):
            self.stack.append(tag)
            self.skip += 1
            return
        if self.skip:
            return
        if tag in BLOCK:
            self.flush()
        if re.fullmatch("h[1-6]", tag):
            self.prefix = "#" * min(int(tag[1]), 5) + " "
        elif tag == "li":
            self.prefix = "- "
        elif "marginalia" in kinds:
            self.prefix = "###### "
        elif tag == "a" and attrs.get("href"):
            self.link = attrs["href"]
            self.line.append("\0")

    def closed(self, tag: str) -> None:
        if self.skip:
            if tag in self.stack:  # unclosed elements inside end with it
                while self.stack:
                    self.skip -= 1
                    if self.stack.pop() == tag:
                        break
            return
        if tag == "a" and self.link is not None and "\0" in self.line:
            at = len(self.line) - 1 - self.line[::-1].index("\0")
            shown = "".join(self.line[at + 1 :]).strip()
            if re.match(r"(?:§|Art\.)\s*\d", shown):
                url = self.link if re.match("https?:", self.link) else self.base + self.link
                self.line[at:] = [f"[⟨{shown}⟩]({url})"]
            else:
                self.line[at:] = [shown]
            self.link = None
        if tag in BLOCK:
            self.flush()

    def said(self, data: str) -> None:
        if not self.skip:
            self.line.append(data)


def markdown_of(html: str | None, base: str = "") -> str:
    walk = _run(_Markdown(base), html)
    walk.flush()
    return re.sub(r"\n{3,}", "\n\n", "\n".join(walk.lines).replace("\0", "")).strip()


class _Clean(_Walk):
    def __init__(self) -> None:
        super().__init__()
        self.parts: list[str] = []

    def opened(self, tag: str, attrs: dict[str, str]) -> None:
        if tag not in ("meta", "link"):
            kept = "".join(f' {k}="{escape(v)}"' for k, v in attrs.items() if k not in UNWANTED)
            self.parts.append(f"<{tag}{kept}>")

    def closed(self, tag: str) -> None:
        if tag not in VOID:
            self.parts.append(f"</{tag}>")

    def said(self, data: str) -> None:
        self.parts.append(escape(data, quote=False))


def clean_html(html: str | None) -> str:
    """Without scripts, styles, unwanted attributes and empty elements."""
    out = "".join(_run(_Clean(), html).parts)
    while (less := re.sub(r"<(p|span|div|b|i|em|strong)(?: [^<>]*)?>\s*</\1>", "", out)) != out:
        out = less
    return re.sub(r"[^\S\n]+", " ", out)


def common_runs(a: list[str], b: list[str]) -> list[tuple[int, int, int]]:
    """Runs of equal words (start in a, start in b, length), in order.

    Equal beginnings and ends come first.  Between them the words that either text
    holds once, in their longest common order, split the rest into small parts; only
    parts without such a word are compared word by word.
    """
    out: list[tuple[int, int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        head = 0
        while i + head < j and k + head < m and a[i + head] == b[k + head]:
            head += 1
        tail = 0
        while j - tail > i + head and m - tail > k + head and a[j - tail - 1] == b[m - tail - 1]:
            tail += 1
        out += [(i, k, head)] * bool(head) + [(j - tail, m - tail, tail)] * bool(tail)
        i, j, k, m = i + head, j - tail, k + head, m - tail
        if i == j or k == m:
            continue
        once_a, once_b = Counter(a[i:j]), Counter(b[k:m])
        places = {w: n for n, w in enumerate(b[k:m], k) if once_b[w] == 1}
        pairs = [(n, places[w]) for n, w in enumerate(a[i:j], i) if once_a[w] == 1 and w in places]
        chain = _longest_rising(pairs)
        if not chain:
            out += [(i + x.a, k + x.b, x.size) for x in difflib.SequenceMatcher(None, a[i:j], b[k:m], autojunk=False).get_matching_blocks() if x.size]
            continue
        edges = [(i, k), *chain, (j, m)]
        # Each part begins with the word that it is anchored at.
        todo += [(low[0], high[0], low[1], high[1]) for low, high in zip(edges, edges[1:], strict=False)]
    return sorted(out)


def _longest_rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence whose second numbers rise."""
    ends: list[int] = []
    last: list[int] = []
    back: list[int] = []
    for n, (_, y) in enumerate(pairs):
        at = bisect.bisect_left(ends, y)
        back.append(last[at - 1] if at else -1)
        if at == len(ends):
            ends.append(y)
            last.append(n)
        else:
            ends[at], last[at] = y, n
    out, n = [], last[-1] if last else -1
    while n >= 0:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


def diff_words(old: str | None, new: str | None) -> tuple[int, int, str]:
    """(words removed, words added, marked text) between two pages' texts."""
    a, b = text_of(old).split(), text_of(new).split()
    gone = added = i = k = 0
    out: list[str] = []
    for x, y, n in [*common_runs(a, b), (len(a), len(b), 0)]:
        gone, added = gone + x - i, added + y - k
        if x > i:
            out.append(f"<del>{' '.join(a[i:x])}</del>")
        if y > k:
            out.append(f"<ins>{' '.join(b[k:y])}</ins>")
        out += a[x : x + n]
        i, k = x + n, y + n
    return gone, added, " ".join(out)


class _Elements(_Walk):
    """Every element with its attributes, own path depth and text."""

    def __init__(self) -> None:
        super().__init__()
        self.out: list[dict] = []
        self.open: list[tuple[str, int]] = []

    def opened(self, tag: str, attrs: dict[str, str]) -> None:
        self.out.append({"position": len(self.out), "tag": tag, "depth": len(self.open), "attributes": attrs, "text": ""})
        if tag not in VOID:
            self.open.append((tag, len(self.out) - 1))

    def closed(self, tag: str) -> None:
        if any(t == tag for t, _ in self.open):
            while self.open.pop()[0] != tag:
                pass

    def said(self, data: str) -> None:
        for _, k in self.open:
            self.out[k]["text"] += data


def elements_of(html: str | None, tag: str | None = None, attribute: str | None = None, value: str | None = None) -> list[dict]:
    """Elements by tag, by attribute and by its value; of ``class``, one of its words."""
    out = []
    for e in _run(_Elements(), html).out:
        if tag and e["tag"] != tag or attribute and attribute not in e["attributes"]:
            continue
        if attribute and value is not None and (value not in e["attributes"][attribute].split() if attribute == "class" else e["attributes"][attribute] != value):
            continue
        out.append(e | {"text": " ".join(e["text"].split())})
    return out


class _Tables(_Walk):
    def __init__(self) -> None:
        super().__init__()
        self.out: list[dict] = []
        self.open: list[int] = []
        self.cell = False

    def opened(self, tag: str, attrs: dict[str, str]) -> None:
        if tag == "table":
            self.out.append({"rows": [], "heads": 0, "caption": attrs.get("id", "")})
            self.open.append(len(self.out) - 1)
            self.cell = False
        elif self.open:
            rows = self.out[self.open[-1]]["rows"]
            if tag == "tr":
                rows.append([])
            elif tag in ("td", "th"):
                if not rows:
                    rows.append([])
                rows[-1].append(["", tag])
                self.cell = True

    def closed(self, tag: str) -> None:
        if tag == "table" and self.open:
            self.open.pop()
        elif tag in ("td", "th"):
            self.cell = False

    def said(self, data: str) -> None:
        if self.open and self.cell:
            self.out[self.open[-1]]["rows"][-1][-1][0] += data


def tables_of(html: str | None) -> list[dict]:
    """Tables as rectangular grids, with the number of header rows.

    Header rows are those of ``th`` alone at the top; failing that the first row is
    one if all its texts are short and none ends a sentence.
    """
    out = []
    for t in _run(_Tables(), html).out:
        rows = [[" ".join(text.split()) for text, _ in r] for r in t["rows"] if r]
        kinds = [{k for _, k in r} for r in t["rows"] if r]
        width = max(map(len, rows), default=0)
        heads = 0
        while heads < len(kinds) and kinds[heads] == {"th"}:
            heads += 1
        if not heads and len(rows) > 1 and all(0 < len(c) < 50 and not re.search("[.!?]", c) for c in rows[0]):
            heads = 1
        out.append({"id": t["caption"], "grid": [r + [""] * (width - len(r)) for r in rows], "header_rows": heads})
    return out


def table_html(grid: list[list[str]], header_rows: int = 1) -> str:
    """A grid as a table with head and body."""
    row = lambda cells, tag: "<tr>" + "".join(f"<{tag}>{escape(c, quote=False)}</{tag}>" for c in cells) + "</tr>"
    head, body = "".join(row(r, "th") for r in grid[:header_rows]), "".join(row(r, "td") for r in grid[header_rows:])
    return f"<table>{f'<thead>{head}</thead>' if head else ''}<tbody>{body}</tbody></table>"


def table_paragraphs(grid: list[list[str]]) -> str:
    """A rejected table as a paragraph a row."""
    return "".join(f"<p>{escape(' '.join(c for c in r if c), quote=False)}</p>" for r in grid if any(r))


def grid_hash(grid: list[list[str]]) -> str:
    """16 hex digits over the non-blank cells in document order."""
    return hashlib.sha256("|".join(c for r in grid for c in r if c).encode()).hexdigest()[:16]


class _Lists(_Walk):
    def __init__(self) -> None:
        super().__init__()
        self.level, self.out, self.part = 0, [], None

    def opened(self, tag: str, attrs: dict[str, str]) -> None:
        if tag == "dl":
            self.level += 1
        elif tag == "dt" and self.level:
            self.out.append({"level": self.level, "term": "", "text": ""})
            self.part = "term"
        elif tag == "dd" and self.level:
            if not self.out or self.part != "term":
                self.out.append({"level": self.level, "term": "", "text": ""})
            self.part = "text"

    def closed(self, tag: str) -> None:
        if tag == "dl":
            self.level = max(0, self.level - 1)
        if tag in ("dl", "dd"):
            self.part = None

    def said(self, data: str) -> None:
        if self.part and self.out:
            self.out[-1][self.part] += data


def definitions_of(html: str | None) -> list[dict]:
    """(level, term, text) of definition lists, nested ones after what holds them."""
    return [d | {"term": " ".join(d["term"].split()), "text": " ".join(d["text"].split())} for d in _run(_Lists(), html).out]


def definition(html: str | None, term: str) -> str | None:
    """The text of the first definition of a term."""
    return next((d["text"] for d in definitions_of(html) if d["term"].rstrip(":") == term.rstrip(":")), None)


def redirect_of(html: str | None, base: str = "") -> str | None:
    """The target of a script's ``window.location``, joined to the base."""
    m = re.search(r"""window\.location(?:\.href)?\s*=\s*["']([^"']+)["']""", html or "") or re.search(r"""window\.location\.replace\(\s*["']([^"']+)["']""", html or "")
    return m and (m[1] if re.match("https?:", m[1]) else base.rstrip("/") + "/" + m[1].lstrip("/"))


def _mapped(df: DataFrame, name: str, kind: str, f, *columns: str) -> DataFrame:
    ship(df.sparkSession)

    @F.pandas_udf(kind)
    def run(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for part in parts:
            rows = zip(*((part,) if isinstance(part, pd.Series) else part), strict=True)  # one column comes bare
            yield pd.Series([f(*row) for row in rows], dtype=object)

    return df.withColumn(name, run(*columns))


def visible_text(df: DataFrame, key: str, html: str) -> DataFrame:
    return _mapped(df, "text", "string", text_of, html).select(key, "text")


def to_markdown(df: DataFrame, key: str, html: str, base: str = "") -> DataFrame:
    return _mapped(df, "markdown", "string", lambda h: markdown_of(h, base), html).select(key, "markdown")


def cleaned(df: DataFrame, key: str, html: str) -> DataFrame:
    return _mapped(df, "html", "string", clean_html, html).select(key, "html")


def links(df: DataFrame, key: str, html: str, base: str) -> DataFrame:
    """(key, position, href, text, absolute, external): relative links joined to the page's host."""
    out = _mapped(df, "_links", "array<struct<href:string,text:string>>", lambda h: [{"href": a, "text": t} for a, t in links_of(h)], html)
    rows = out.select(key, base, F.posexplode("_links").alias("position", "_l")).select(key, base, "position", "_l.*")
    root = F.regexp_extract(base, r"^(https?://[^/?#]*)", 1)
    absolute = F.when(F.col("href").rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), F.col("href")).when(F.col("href").startswith("/"), F.concat(root, "href")).when(F.col("href").startswith("#"), F.concat(F.regexp_extract(base, "^([^#]*)", 1), "href")).otherwise(F.concat(root, F.lit("/"), "href"))
    return rows.withColumn("absolute", absolute).withColumn("external", ~F.col("absolute").startswith(root)).drop(base)


def tag_counts(df: DataFrame, key: str, html: str) -> DataFrame:
    out = _mapped(df, "_t", "array<struct<tag:string,n:long>>", lambda h: [{"tag": t, "n": n} for t, n in sorted(_run(_Tags(), h).counts.items())], html)
    return out.select(key, F.inline("_t"))


def diff(df: DataFrame, keys: list[str], old: str, new: str) -> DataFrame:
    # A pair costs far more than its bytes say, so pairs are dealt over all cores by a stated number.
    session = df.sparkSession
    n = max(session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions")))
    df = df.repartition(n, *keys)
    out = _mapped(df, "_d", "array<struct<removed:int,added:int,marked:string>>", lambda a, b: [dict(zip(("removed", "added", "marked"), diff_words(a, b), strict=True))], old, new)
    return out.select(*keys, F.inline("_d"))


def anchors(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, prov, sub, seq) of the anchor ids in a page, as ``segment.anchor_map`` reads them."""
    from codexlake.functions.scalar import anchor_parts

    found = _mapped(df, "_a", "array<string>", lambda h: [e["attributes"]["id"] for e in elements_of(h, attribute="id") if e["attributes"]["id"].startswith("seq-")], html)
    rows = found.select(key, F.explode("_a").alias("_id")).withColumn("_p", anchor_parts("_id")).where("_p.prov is not null")
    return rows.select(key, "_p.prov", "_p.sub", "_p.seq")


def tables(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, position, hash, header_rows, grid) of every table in a page."""
    kind = "array<struct<hash:string,header_rows:int,grid:array<array<string>>>>"
    out = _mapped(df, "_t", kind, lambda h: [{"hash": grid_hash(t["grid"]), "header_rows": t["header_rows"], "grid": t["grid"]} for t in tables_of(h)], html)
    return out.select(key, F.posexplode("_t").alias("position", "_r")).select(key, "position", "_r.*")


def apply_table_decisions(html: str | None, outcomes: dict[str, tuple[str, list[list[str]] | None]]) -> str:
    """A page whose tables are kept, rebuilt, turned into paragraphs or dropped.

    ``outcomes`` has (outcome, corrected grid) by content hash; a merged table goes,
    its rows being part of the corrected grid of its target.
    """
    grids = iter(tables_of(html))

    def one(m: re.Match) -> str:
        t = next(grids)
        outcome, corrected = outcomes.get(grid_hash(t["grid"]), ("kept", None))
        if outcome == "rebuilt" and corrected:
            return table_html(corrected, max(1, t["header_rows"]))
        if outcome == "untabled":
            return table_paragraphs(t["grid"])
        return "" if outcome == "merged" else m[0]

    return re.sub(r"(?is)<table\b.*?</table\s*>", one, html or "")


def federal_pages(df: DataFrame, html: str, name: str = "page") -> DataFrame:
    """A federal text's raw HTML as the paragraphs of its page.

    Head, comments, scripts and styles go first; then headings become notes and
    provisions, numbers sub-provisions with anchors, headings move down, footnotes
    to the end, references in notes are linked, and each provision is one container.
    """
    from codexlake.operators import crossref, passes

    bare = F.regexp_replace(F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<head\b.*?</head\s*>|<!--.*?-->|<\?.*?\?>|<!doctype[^>]*>|<(script|style)\b.*?</\1\s*>", ""), r"""(?i)\s+(?:style|align|valign)\s*=\s*"[^"]*\"""", "")
    items = passes.read_paragraphs(df.withColumn("_bare", bare), "_bare", "_items")
    *text, group = passes.FEDERAL_PAGE
    done = passes.rewrite(items, "_items", *text, crossref.link_references(*crossref.SCOPES), group)
    return done.withColumn(name, passes.markup("_items")).drop("_bare", "_items")
