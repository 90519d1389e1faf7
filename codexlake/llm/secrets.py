"""Secret scan: fixed patterns, and a lexer that knows assignments.

The lexer reads source and configuration syntax into (name, expression) pairs
(``name = "x"``, ``"name": "x"``, ``NAME=x``, ``name := x``, ``name => x``), keeps
the constants that names hold, follows references and ``+`` between them, and
scores each literal that reaches a name by how sensitive the name is and how much
the literal looks like key material.  A literal above the threshold is a span of
kind ``literal``, placed where it is written, however many names it passed.

Literals are quoted strings, and bare values in configuration syntax: a pair alone
on its line.  A reference to a name that holds no known constant, or a call, is no
literal; a bare word without a digit is such a reference.

Defined cases: a null or empty text has no spans; a very long text is read whole, in
time linear in its length; spans are code points, end exclusive; matches of one kind
never overlap; equal texts and repeated rows give equal spans; an empty table gives
no rows; other columns of the input, whatever their names, are not read by
``scan_secrets`` and not changed by ``redact_secrets``.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexlake.llm.common import on_workers, texts_of

#: Kinds in the order that breaks ties at one start.
KINDS = ("assign", "access", "hex", "literal")
_ASSIGN = re.compile(r"""(?a)((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
# Runs are maximal, so a lower bound on the length is the same as dropping short runs.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_WORDS = ("pass", "secret", "token", "api")

#: A name starts where no name goes on, and is taken whole, so that long runs are read once.
_PAIR = re.compile(
    r"""(?P<name>(?<![\w$.\-])[\w$.\-]++|"[^"\n]+"|'[^'\n]+')(?:\[(?P<item>"[^"\n]+"|'[^'\n]+')\])?[^\S\n]*(?::=|=>|=(?![=>~])|:(?![:/=]))[^\S\n]*"""
)
_TERM = re.compile(r"""(?P<quoted>[rbuf]{0,2}(?:"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`))|(?P<ref>\$?\{?[A-Za-z_][\w.]*\}?(?![\w+/=-]))|(?P<bare>[^\s,;"'`(){}<>\[\]]+)""")
#: What may stand before the name and after the value where a line of configuration holds nothing else.
_LINE_HEAD = re.compile(r"[+\-\s]*(?:(?:export|set|ENV)\s+)?")
_LINE_END = re.compile(r"[^\S\n]*(?:#[^\n]*)?(?:\n|\Z)")
_PLUS = re.compile(r"\s*\+\s*")
#: Parts of names, and how sensitive a name with that part is.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9,
    "private": 0.6, "key": 0.55, "auth": 0.6, "signature": 0.5, "salt": 0.5, "bearer": 0.8, "access": 0.35, "client": 0.2, "api": 0.4, "dsn": 0.6, "cert": 0.4,
}
#: Parts that say the value is not itself the secret.
HARMLESS = {"public", "name", "id", "path", "file", "url", "hint", "length", "count", "type", "label", "field", "header", "max", "min"}
PLACEHOLDERS = re.compile(r"(?i)^(?:x+|\*+|\.+|<.*>|\$\{.*\}|%.*%|change_?me|example.*|your[_-].*|none|null|true|false|todo|dummy|test|password|secret)$")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the three fixed patterns."""
    out: list[tuple[int, int, str]] = []
    if ("=" in text or ":" in text) and any(w in (low := text.lower()) for w in _WORDS):
        out += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
        del low
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in _ACCESS.finditer(text)]
    out += [(*m.span(), "hex") for m in _HEX.finditer(text)]
    return out


def name_score(name: str) -> float:
    """0 to 1: how sensitive a target of this name is."""
    parts = re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+", name)
    words = [p.lower() for p in parts]
    joined = [a + b for a, b in zip(words, words[1:], strict=False)]
    miss = 1.0
    for w in dict.fromkeys(words + joined):
        miss *= 1.0 - SENSITIVE.get(w, 0.0) * (0.999 if SENSITIVE.get(w, 0) == 1 else 1)
    return (1.0 - miss) * (0.25 if words and words[-1] in HARMLESS or "public" in words else 1.0)


def literal_score(value: str) -> float:
    """0 to 1: how much a literal looks like key material."""
    n = len(value)
    if n < 6 or PLACEHOLDERS.match(value) or any(c.isspace() for c in value):
        return 0.0
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(value).values())
    kinds = sum(bool(re.search(p, value)) for p in (r"[a-z]", r"[A-Z]", r"[0-9]", r"[^A-Za-z0-9]"))
    return min(1.0, entropy / 3.5) * min(1.0, n / 12) * (0.55 + 0.15 * kinds)


def literal_spans(text: str, threshold: float = 0.4) -> list[tuple[int, int, str]]:
    """Literals that reach a sensitive name, with constants followed."""
    if "=" not in text and ":" not in text:
        return []
    constants: dict[str, list[tuple[str, int, int]]] = {}
    found: dict[tuple[int, int], float] = {}
    at, looked, found_any = 0, 0, False
    while m := _PAIR.search(text, at):
        name = (m["item"] or m["name"]).strip("\"'")
        # Line starts are looked for from the last pair on, so that a long line is read once.
        new, looked = text.rfind("\n", looked, m.start()) + 1, m.start()
        alone = (new > 0 or not found_any) and bool(_LINE_HEAD.fullmatch(text, new, m.start()))
        at, parts, first, refs, code, plus, found_any = m.end(), [], True, 0, False, None, True
        while first or (plus := _PLUS.match(text, at)):
            term = _TERM.match(text, at if first else plus.end())
            if not term:
                break
            # Over a line end only code goes on: not a list, nor a patch whose next line is an assignment.
            if not first and "\n" in plus[0] and (_PAIR.match(text, plus.end()) or not (code or term["quoted"])):
                break
            first, at, code = False, term.end(), True
            if quoted := term["quoted"]:
                lead = len(quoted) - len(quoted.lstrip("rbuf")) + 1
                parts.append((quoted[lead:-1], term.start() + lead, term.end() - 1))
            elif (ref := term["ref"]) and (known := constants.get(ref.strip("${}")) or constants.get(ref.strip("${}").rsplit(".", 1)[-1])):
                parts += known
                refs += 1
            else:
                code = False
                if alone and plus is None and _LINE_END.match(text, at) and (term["bare"] or not (set(ref) & set("${}.")) and any(map(str.isdigit, ref))):
                    parts.append((term[0], *term.span()))
        constants[name.rsplit(".", 1)[-1]] = list(dict.fromkeys(parts)) if refs > 1 else parts  # each literal once, so that x = x + x does not double
        if (weight := name_score(name)) and weight * literal_score("".join(p[0] for p in parts)) >= threshold:
            for _, start, end in parts:
                if end - start >= 4:
                    found[start, end] = weight
    out, last = [], -1
    for start, end in sorted(found):
        if start >= last:
            out.append((start, end, "literal"))
            last = end
    return out


def ordered(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redact(text: str, spans: list[tuple[int, int, str]], mark: str = "[SECRET]") -> str:
    """The text with each stretch that spans cover replaced by one mark."""
    out, at, covered = [], 0, -1
    for start, end, _ in ordered(spans):
        if start >= covered:
            out += [text[at:start], mark]
            at = covered = end
        elif end > covered:
            at = covered = end
    return "".join(out) + text[at:]


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.4) -> DataFrame:
    """Per row: the spans of all kinds, as structs in order, and per-kind counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[], [], [], []]
            digests, spelled, structs = [], [], []
            for text in texts_of(batch.column(1)):
                base = ordered(base_spans(text))
                more = literal_spans(text, threshold)
                tally = Counter(s[2] for s in base)
                for k, kind in enumerate(KINDS[:3]):
                    counts[k].append(tally[kind])
                counts[3].append(len(more))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans = ordered(base + more)
                spelled.append(joined(spans))
                structs.append([{"kind": k, "start": s, "end": e} for s, e, k in spans])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spelled, pa.string()), pa.array(structs, kind)],
                ["id", "n_assign", "n_access", "n_hex", "n_literal", "base_sha256", "spans", "span_list"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    out = on_workers(df).select(id_col, text_col).mapInArrow(
        run, f"id {kind}, n_assign long, n_access long, n_hex long, n_literal long, base_sha256 string, spans string, span_list array<struct<kind:string,start:long,end:long>>"
    )
    return out.withColumnRenamed("id", id_col)


def redact_secrets(df: DataFrame, text_col: str = "text", threshold: float = 0.4) -> DataFrame:
    """Replace every span in ``text_col`` by a mark; other columns stay as they are.

    A null text stays null.
    """

    on_workers(df)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else redact(t, base_spans(t) + literal_spans(t, threshold)))

    return df.withColumn(text_col, clean(F.col(text_col)))
