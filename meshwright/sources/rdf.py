"""RDF files: N-Triples (distributed), Turtle and RDF/XML (one file per task), and writers."""

from __future__ import annotations

import os
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from urllib.parse import urljoin
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwright.operators.triples import COLUMNS, union
from meshwright.vocab import RDF, TRIPLES, TYPE, XSD

SCHEMA = "s string, p string, o string, o_kind string, o_datatype string, o_lang string"
#: Possessive repeats, so that no long literal or blank node nests the matcher.
_NT = r'^\s*(<[^>]*>|_:\S+)\s+<([^>]*)>\s+(?:<([^>]*)>|(_:[^\s.]++(?:\.[^\s.]++)*+)|"((?:[^"\\]++|\\.)*+)"(?:\^\^<([^>]*)>|@([A-Za-z0-9-]+))?)\s*\.\s*(?:#.*)?$'
_PIECE = r"[^\\]++|(?:\\u[0-9A-Fa-f]{4})++|\\U[0-9A-Fa-f]{8}|\\."


def unescaped(text: Column) -> Column:
    """Escapes of N-Triples decoded: letters, and code points of four or eight digits (pairs of surrogates together)."""
    plain = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f"}
    table = F.create_map(*[F.lit(x) for kv in plain.items() for x in kv])

    def decoded(x: Column) -> Column:
        code = lambda kind, charset: F.decode(F.unhex(F.replace(x, F.lit(kind), F.lit(""))), charset)
        letter = F.substr(x, F.lit(2), F.lit(1))
        wide = F.length(x) > 2
        return F.when(~x.startswith("\\"), x).when(wide & x.startswith("\\u"), code("\\u", "UTF-16BE")).when(wide, code("\\U", "UTF-32")).otherwise(F.coalesce(table[letter], letter))

    return F.when(F.contains(text, F.lit("\\")), F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0)), decoded), "")).otherwise(text)


def parse_ntriples(lines: DataFrame, strict: bool = False) -> DataFrame:
    """The triples of ``lines(value)``, one a line. Blank lines and comments are left out; so are malformed lines, which are an error when ``strict``."""
    part = lambda i: F.regexp_extract("value", _NT, i)
    filled = lambda c: F.nullif(c, F.lit(""))
    good = F.col("value").rlike(_NT)
    if strict:
        good = F.when(good, F.lit(True)).when(F.col("value").rlike(r"^\s*(?:#|$)"), F.lit(False)).otherwise(F.raise_error(F.concat(F.lit("N-Triples: unexpected line: "), F.substring("value", 1, 80))))
    rows = lines.where(good)
    kind = F.when(filled(part(3)).isNotNull(), "iri").when(filled(part(4)).isNotNull(), "bnode").otherwise("literal")
    return rows.select(unescaped(F.regexp_replace(part(1), "^<|>$", "")).alias("s"), unescaped(part(2)).alias("p"), F.coalesce(unescaped(filled(part(3))), filled(part(4)), unescaped(part(5))).alias("o"), kind.alias("o_kind"), filled(part(6)).alias("o_datatype"), filled(part(7)).alias("o_lang")).distinct()


def read_ntriples(spark: SparkSession, path: str | list[str], strict: bool = False) -> DataFrame:
    return parse_ntriples(spark.read.text(path), strict)


_TOKEN = re.compile(
    r"""\s+|\#[^\n]*|(?P<iri><[^<>"{}|^`\\\s]*>)|(?P<text>\"\"\"(?:[^"\\]|\\.|"(?!""))*\"\"\"|'''(?:[^'\\]|\\.|'(?!''))*'''|"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')
    |(?P<lang>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)|(?P<type>\^\^)|(?P<num>[+-]?(?:\d+\.\d*|\.?\d+)(?:[eE][+-]?\d+)?(?![\w:]))|(?P<bnode>_:[\w.-]*\w)
    |(?P<name>[^\W\d_]?[\w.-]*:(?:[\w:%-]|\.(?=[\w:%-])|\\.)*)|(?P<word>[A-Za-z]+)|(?P<mark>[;,.\[\]()])""",
    re.X,
)
_ESCAPE = re.compile(r"\\(u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)", re.S)


def _unescape(text: str) -> str:
    plain = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f"}
    return _ESCAPE.sub(lambda m: chr(int(m[1][1:], 16)) if m[1][0] in "uU" and len(m[1]) > 1 else plain.get(m[1], m[1]), text)


class Turtle:
    """Turtle to rows: prefixes, base, predicate and object lists, collections, blank nodes, literals."""

    def __init__(self, text: str, base: str = "", scope: str = "b"):
        self.tokens, self.at = self._split(text), 0
        self.base, self.prefixes, self.rows, self.scope, self.blank = base, {}, [], scope, 0

    @staticmethod
    def _split(text: str) -> list[tuple[str, str]]:
        out, at = [], 0
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m or m.end() == at:
                raise ValueError(f"Turtle: unexpected text at {at}: {text[at : at + 30]!r}")
            if m.lastgroup:
                out.append((m.lastgroup, m[0]))
            at = m.end()
        return out

    def next(self) -> tuple[str, str]:
        if self.at >= len(self.tokens):
            raise ValueError("Turtle: unexpected end")
        self.at += 1
        return self.tokens[self.at - 1]

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("", "")

    def want(self, mark: str) -> None:
        if (t := self.next()) != ("mark", mark):
            raise ValueError(f"Turtle: expected {mark!r}, found {t[1]!r}")

    def fresh(self) -> str:
        self.blank += 1
        return f"_:{self.scope}{self.blank}"

    def iri(self, kind: str, text: str) -> str:
        if kind == "iri":
            return urljoin(self.base, _unescape(text[1:-1])) if self.base else _unescape(text[1:-1])
        prefix, _, local = text.partition(":")
        if prefix not in self.prefixes:
            raise ValueError(f"Turtle: unknown prefix {prefix!r}")
        return self.prefixes[prefix] + re.sub(r"\\(.)", r"\1", local)

    def parse(self) -> list[tuple]:
        while self.at < len(self.tokens):
            kind, text = self.peek()
            word = text.lower()
            if (kind, word) in (("lang", "@prefix"), ("word", "prefix")):
                self.next()
                name = self.next()[1]
                self.prefixes[name[:-1]] = self.iri(*self.next())
            elif (kind, word) in (("lang", "@base"), ("word", "base")):
                self.next()
                self.base = self.iri(*self.next())
            else:
                lone = (kind, text) == ("mark", "[")
                subject = self.node()[0]
                if not (lone and self.peek() == ("mark", ".")):
                    self.statements(subject)
                self.want(".")
                continue
            if kind == "lang":
                self.want(".")
        return self.rows

    def statements(self, subject: str) -> None:
        while True:
            kind, text = self.next()
            predicate = TYPE if (kind, text) == ("word", "a") else self.iri(kind, text)
            while True:
                self.rows.append((subject, predicate, *self.node()))
                if self.peek() != ("mark", ","):
                    break
                self.next()
            while self.peek() == ("mark", ";"):
                self.next()
            if self.peek()[1] in (".", "]"):
                return

    def node(self) -> tuple:
        kind, text = self.next()
        if kind in ("iri", "name"):
            return self.iri(kind, text), "iri", None, None
        if kind == "bnode":
            return f"_:{self.scope}-{text[2:]}", "bnode", None, None
        if kind == "num":
            return text, "literal", XSD + ("double" if "e" in text.lower() else "decimal" if "." in text else "integer"), None
        if kind == "word" and text in ("true", "false"):
            return text, "literal", f"{XSD}boolean", None
        if kind == "text":
            n = 3 if text[:3] in ('"""', "'''") else 1
            value = _unescape(text[n:-n])
            if self.peek()[0] == "lang":
                return value, "literal", None, self.next()[1][1:]
            if self.peek()[0] == "type":
                self.next()
                return value, "literal", self.iri(*self.next()), None
            return value, "literal", None, None
        if text == "[":
            me = self.fresh()
            if self.peek() != ("mark", "]"):
                self.statements(me)
            self.want("]")
            return me, "bnode", None, None
        if text == "(":
            items = []
            while self.peek() != ("mark", ")"):
                items.append(self.node())
            self.next()
            rest, kind = f"{RDF}nil", "iri"
            for item in reversed(items):
                me = self.fresh()
                self.rows += [(me, f"{RDF}first", *item), (me, f"{RDF}rest", rest, kind, None, None)]
                rest, kind = me, "bnode"
            return rest, kind, None, None
        raise ValueError(f"Turtle: unexpected {text!r}")


def parse_rdfxml(text: str | bytes, base: str = "", scope: str = "x") -> list[tuple]:
    """RDF/XML: typed nodes, property elements and attributes, nested nodes, resources, collections, languages and datatypes."""
    rows, blank = [], [0]
    xml = "{http://www.w3.org/XML/1998/namespace}"
    r = lambda n: f"{{{RDF}}}{n}"
    flat = lambda tag: tag[1:].replace("}", "", 1)

    def fresh() -> str:
        blank[0] += 1
        return f"_:{scope}{blank[0]}"

    def full(ref: str, at: str) -> str:
        return urljoin(at, ref) if at else ref

    def node(e: ET.Element, lang: str | None, at: str) -> tuple[str, str]:
        lang, at = e.get(f"{xml}lang", lang) or None, e.get(f"{xml}base", at)
        if e.get(r("about")) is not None:
            me, kind = full(e.get(r("about")), at), "iri"
        elif e.get(r("ID")) is not None:
            me, kind = full("#" + e.get(r("ID")), at), "iri"
        else:
            me, kind = (f"_:{scope}-{e.get(r('nodeID'))}" if e.get(r("nodeID")) else fresh()), "bnode"
        if e.tag != r("Description"):
            rows.append((me, TYPE, flat(e.tag), "iri", None, None))
        for k, v in e.attrib.items():
            if k == r("type"):
                rows.append((me, TYPE, full(v, at), "iri", None, None))
            elif k.startswith("{") and not k.startswith((f"{{{RDF}}}", xml)):
                rows.append((me, flat(k), v, "literal", None, lang))
        for child in e:
            member(me, child, lang, at)
        return me, kind

    def member(me: str, e: ET.Element, lang: str | None, at: str) -> None:
        lang, at, p = e.get(f"{xml}lang", lang) or None, e.get(f"{xml}base", at), flat(e.tag)
        how = e.get(r("parseType"))
        if e.get(r("resource")) is not None:
            rows.append((me, p, full(e.get(r("resource")), at), "iri", None, None))
        elif e.get(r("nodeID")) is not None:
            rows.append((me, p, f"_:{scope}-{e.get(r('nodeID'))}", "bnode", None, None))
        elif how == "Resource":
            inner = fresh()
            rows.append((me, p, inner, "bnode", None, None))
            for child in e:
                member(inner, child, lang, at)
        elif how == "Collection":
            rest, kind = f"{RDF}nil", "iri"
            for item, item_kind in reversed([node(c, lang, at) for c in e]):
                cell = fresh()
                rows.extend([(cell, f"{RDF}first", item, item_kind, None, None), (cell, f"{RDF}rest", rest, kind, None, None)])
                rest, kind = cell, "bnode"
            rows.append((me, p, rest, kind, None, None))
        elif len(e):
            for child in e:
                rows.append((me, p, *node(child, lang, at), None, None))
        else:
            kind = e.get(r("datatype"))
            rows.append((me, p, e.text or "", "literal", full(kind, at) if kind else None, None if kind else lang))

    root = ET.fromstring(text)
    at, lang = root.get(f"{xml}base", base), root.get(f"{xml}lang")
    for e in root if root.tag == r("RDF") else [root]:
        node(e, lang, at)
    return rows


def parse_text(text: str, name: str, base: str = "", scope: str = "b") -> list[tuple]:
    ext = name.lower().rsplit(".", 1)[-1]
    xml = ext in ("rdf", "owl", "xml") or ext not in ("ttl", "n3", "nt", "turtle") and text.lstrip().startswith("<?xml")
    if xml and text.lstrip().startswith("<"):
        return parse_rdfxml(text.encode("utf-8"), base, scope)
    return Turtle(text, base, scope).parse()


def parse_contents(files: DataFrame, base: str = "", strict: bool = True) -> DataFrame:
    """Triples of ``files(path, content)``, one file per task; blank nodes are kept apart by file. Not strict: files that can't be parsed give none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zlib

        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                try:
                    rows = parse_text(bytes(content).decode("utf-8-sig", "replace"), name, base, f"b{zlib.crc32(name.encode()):08x}n")
                except (ValueError, ET.ParseError):
                    if strict:
                        raise
                    rows = []
                yield pd.DataFrame(rows, columns=COLUMNS, dtype=object)

    return files.select("path", "content").mapInPandas(run, SCHEMA)


def read(spark: SparkSession, path: str | list[str], base: str = "", strict: bool = True) -> DataFrame:
    """Triples of RDF files of any of the formats: N-Triples by line, others one file per task. Strict: what can't be parsed is an error."""
    paths = [path] if isinstance(path, str) else list(path)
    lines = [p for p in paths if p.lower().endswith(".nt")]
    files = [p for p in paths if not p.lower().endswith(".nt")]
    parts = [read_ntriples(spark, lines, strict)] if lines else []
    if files:
        parts.append(parse_contents(spark.read.format("binaryFile").load(files), base, strict))
    return union(*parts)


def nt_lines(g: DataFrame) -> DataFrame:
    term = lambda c: F.when(c.startswith("_:"), c).otherwise(F.concat(F.lit("<"), c, F.lit(">")))
    text = F.col("o")
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    lit = F.concat(F.lit('"'), text, F.lit('"'), F.coalesce(F.concat(F.lit("^^<"), "o_datatype", F.lit(">")), F.concat(F.lit("@"), "o_lang"), F.lit("")))
    return g.select(F.concat_ws(" ", term(F.col("s")), term(F.col("p")), F.when(F.col("o_kind") == "literal", lit).otherwise(term(F.col("o"))), F.lit(".")).alias("value"))


def write_ntriples(g: DataFrame, path: str) -> None:
    nt_lines(g.distinct()).write.mode("overwrite").text(path)


def _by_subject(g: DataFrame):
    rows = g.select(*COLUMNS).distinct().orderBy("s", "p", "o", "o_kind", "o_datatype", "o_lang").toLocalIterator()
    subject, group = None, []
    for r in rows:
        if r["s"] != subject and group:
            yield subject, group
            group = []
        subject = r["s"]
        group.append(r)
    if group:
        yield subject, group


def _turtle(g: DataFrame, names: dict[str, str]) -> Iterator[str]:
    esc = lambda t: t.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n").replace("\r", "\\r")

    def term(t: str) -> str:
        if t.startswith("_:"):
            return t
        for p, ns in names.items():
            if t.startswith(ns) and re.fullmatch(r"[A-Za-z_][\w-]*", t[len(ns) :]):
                return f"{p}:{t[len(ns) :]}"
        return f"<{t}>"

    yield from (f"@prefix {p}: <{ns}> .\n" for p, ns in names.items())
    for s, group in _by_subject(g):
        lines = []
        for r in group:
            tail = f"^^{term(r['o_datatype'])}" if r["o_datatype"] else f"@{r['o_lang']}" if r["o_lang"] else ""
            o = f'"{esc(r["o"])}"{tail}' if r["o_kind"] == "literal" else term(r["o"])
            lines.append(f"{'a' if r['p'] == TYPE else term(r['p'])} {o}")
        yield f"\n{term(s)} " + " ;\n    ".join(lines) + " .\n"


def _xml(g: DataFrame) -> Iterator[str]:
    node = lambda t, kind: f"rdf:nodeID={quoteattr(re.sub(r'\W', '_', t[2:]))}" if t.startswith("_:") else f"rdf:{kind}={quoteattr(t)}"
    yield f'<?xml version="1.0" encoding="utf-8"?>\n<rdf:RDF xmlns:rdf="{RDF}">\n'
    for s, group in _by_subject(g):
        yield f"  <rdf:Description {node(s, 'about')}>\n"
        for r in group:
            at = max(r["p"].rfind("#"), r["p"].rfind("/")) + 1
            head = f"    <p:{r['p'][at:]} xmlns:p={quoteattr(r['p'][:at])}"
            if r["o_kind"] == "literal":
                extra = f" rdf:datatype={quoteattr(r['o_datatype'])}" if r["o_datatype"] else f" xml:lang={quoteattr(r['o_lang'])}" if r["o_lang"] else ""
                yield f"{head}{extra}>{escape(r['o'])}</p:{r['p'][at:]}>\n"
            else:
                yield f"{head} {node(r['o'], 'resource')}/>\n"
        yield "  </rdf:Description>\n"
    yield "</rdf:RDF>\n"


def render(g: DataFrame, fmt: str = "xml", prefixes: dict[str, str] | None = None) -> Iterator[str]:
    """The text of a schema-sized graph in portions, in order of its subjects: ``xml``, ``turtle`` or ``nt``."""
    names = {"rdf": RDF, "rdfs": "http://www.w3.org/2000/01/rdf-schema#", "owl": "http://www.w3.org/2002/07/owl#", "xsd": XSD} | (prefixes or {})
    if fmt == "nt":
        return (r["value"] + "\n" for r in nt_lines(g.distinct()).orderBy("value").toLocalIterator())
    if fmt == "turtle":
        return _turtle(g, names)
    if fmt == "xml":
        return _xml(g)
    raise ValueError(f"unknown format: {fmt}")


def serialize(g: DataFrame, path: str, fmt: str = "xml", prefixes: dict[str, str] | None = None) -> str:
    """One file for schema-sized graphs, streamed through the driver: ``xml``, ``turtle`` or ``nt``. Tables go to ``write_ntriples``."""
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    text = render(g, fmt, prefixes)
    with open(path, "w", encoding="utf-8") as f:
        f.writelines(text)
    return path


def from_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, TRIPLES).distinct()
