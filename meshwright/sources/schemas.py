"""Schemas to ontologies: CSV and TSV tables, JSON Schema, XML Schema. A converter turns a file into triples.

Schemas are small, so one file is read in one task; many files are spread over tasks by ``convert_files``.
"""

from __future__ import annotations

import csv
import io
import json
import os
import re
import shutil
import subprocess
import threading
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwright.functions.terms import BOOLEAN_TOKENS, CSV_TYPES, DECIMAL_PATTERN, GENERIC_TYPES, INTEGER_PATTERN, JSON_TYPES, SIMPLE_TYPE_RULES, UNSAFE, boolean_token, date_like, decimal_token, integer_token
from meshwright.operators.triples import COLUMNS, iri, literal
from meshwright.vocab import CLASS, COMMENT, DATATYPE_PROPERTY, DOMAIN, LABEL, OBJECT_PROPERTY, ONTOLOGY, OWL, RANGE, SCHEMA_BASE, SUBCLASS, TRIPLES, TYPE, XSD

#: Texts that conversions emit.
ROW_COMMENT, ALLOWED, UNION_COMMENT = "Represents a row in {}", "Allowed value: {}", "Union type: {}"
VARIANT_COMMENTS = {"allOf": None, "anyOf": "Any of {} variants", "oneOf": "Exactly one of {} variants"}
RESTRICTION, PATTERN, ADDITIONAL, VARIANT = "{}_Required_Restriction", "{}_{}_Pattern", "{}_AdditionalProperty", "{}_{}Variant"

_UNSAFE = str.maketrans(dict.fromkeys(UNSAFE, "_"))


def sanitize(name: str) -> str:
    """The same rule as the column function of this name."""
    bare = re.sub(r"^\{[^}]*\}", "", name).rsplit(":", 1)[-1].translate(_UNSAFE)
    return f"n{bare}" if bare[:1].isdigit() else bare


def sanitize_column(name: str) -> str:
    return sanitize(name.strip()) if name.strip() else "unnamed_column"


@dataclass
class Builder:
    """Collects the triples of one ontology."""

    base: str = SCHEMA_BASE
    rows: dict[tuple, None] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.add(iri(self.base.rstrip("/"), TYPE, ONTOLOGY))

    def add(self, *rows: tuple) -> None:
        self.rows.update(dict.fromkeys(rows))

    def name(self, local: str) -> str:
        return self.base + sanitize(local)

    def term(self, local: str, kind: str, label: str | None = None, comment: str | None = None, domain: str | None = None, range_: str | None = None) -> str:
        me = self.name(local)
        self.add(iri(me, TYPE, kind))
        for p, value in ((LABEL, label), (COMMENT, comment)):
            if value:
                self.add(literal(me, p, str(value)))
        for p, value in ((DOMAIN, domain), (RANGE, range_)):
            if value:
                self.add(iri(me, p, value))
        return me

    def require(self, prop_name: str, prop: str, owner: str) -> None:
        r = self.name(RESTRICTION.format(prop_name))
        self.add(iri(r, TYPE, f"{OWL}Restriction"), iri(r, f"{OWL}onProperty", prop), literal(r, f"{OWL}minCardinality", "1", f"{XSD}integer"), iri(owner, SUBCLASS, r))

    def counts(self) -> dict[str, int]:
        kinds = {CLASS: "classes", OBJECT_PROPERTY: "object_properties", DATATYPE_PROPERTY: "datatype_properties"}
        return {name: len({r[0] for r in self.rows if r[1] == TYPE and r[2] == kind}) for kind, name in kinds.items()}


class Converter:
    """``convert(name, content)`` gives a Builder. Subclasses register themselves by ``kind``."""

    kind = ""
    known: dict[str, type[Converter]] = {}

    def __init__(self, base: str = SCHEMA_BASE, **options):
        self.base, self.options, self.stats = base, options, {}

    def __init_subclass__(cls, **kwargs) -> None:
        super().__init_subclass__(**kwargs)
        if cls.kind:
            Converter.known[cls.kind.lower()] = cls

    def convert(self, name: str, content: bytes) -> Builder:
        raise NotImplementedError


def converter(kind: str, **options) -> Converter:
    if kind.lower() not in Converter.known:
        raise ValueError(f"unknown schema type: {kind}; known: {', '.join(sorted(Converter.known))}")
    return Converter.known[kind.lower()](**options)


# --- tables -------------------------------------------------------------------------------------


def detect_delimiter(name: str, text: str) -> str:
    """Tab for .tsv; else what the first ten lines agree on; else a comma."""
    if name.lower().endswith(".tsv"):
        return "\t"
    try:
        return csv.Sniffer().sniff("\n".join(text.splitlines()[:10]), delimiters=",;\t|").delimiter
    except csv.Error:
        return ","


def read_sample(text: str, delimiter: str, has_header: bool, size: int) -> tuple[list[str], list[list[str]]]:
    """Columns and rows; rows of another width are left out but count for the sample."""
    rows = csv.reader(io.StringIO(text), delimiter=delimiter)
    first = next(rows, None)
    if first is None:
        return [], []
    columns = first if has_header else [f"column_{i}" for i in range(len(first))]
    kept = [] if has_header else [first]
    for i, row in enumerate(rows):
        if i >= size:
            break
        if len(row) == len(columns):
            kept.append(row)
    return columns, kept


def infer_type(values: list[str]) -> str:
    """boolean, integer, decimal, date, string: the first that all values that aren't blank fit; string if there are none."""
    seen = [v.strip() for v in values if v and v.strip()]
    tests = (
        ("boolean", lambda v: v.lower() in BOOLEAN_TOKENS),
        ("integer", lambda v: re.fullmatch(INTEGER_PATTERN, v)),
        ("decimal", lambda v: re.fullmatch(DECIMAL_PATTERN, v)),
        ("date", lambda v: sum(c in "0123456789" for c in v) >= 4 and any(c in "-/." for c in v)),
    )
    return next((kind for kind, fits in tests if seen and all(fits(v) for v in seen)), "string")


def infer_types(table: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """column, type of every column of a table of strings: one aggregate over all rows."""
    columns = columns or table.columns
    tests = (("boolean", boolean_token), ("integer", integer_token), ("decimal", decimal_token), ("date", date_like))
    aggs = []
    for i, c in enumerate(columns):
        v = F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit(""))
        aggs += [F.coalesce(F.every(test(v)), F.lit(False)).alias(f"{kind}{i}") for kind, test in tests]

    def kind(i: int):
        out = F.when(F.col(f"boolean{i}"), "boolean")
        for name, _ in tests[1:]:
            out = out.when(F.col(f"{name}{i}"), name)
        return out.otherwise("string")

    one = table.agg(*aggs)
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), kind(i).alias("type")) for i, c in enumerate(columns)])).alias("x")).select("x.column", "x.type")


def metadata_of_column(metadata: dict, name: str, position: int) -> dict:
    """By name, then by title, then by position."""
    columns = (metadata.get("tableSchema") or metadata).get("columns") or []
    titles = lambda c: c.get("titles") if isinstance(c.get("titles"), list) else [c.get("titles")]
    by = [next((c for c in columns if c.get("name") == name), None), next((c for c in columns if name in titles(c)), None), columns[position] if position < len(columns) else None]
    return next((c for c in by if c is not None), {})


class TableConverter(Converter):
    """Options: delimiter, has_header, sample_size, row_class, type_mapping, metadata (a CSVW description)."""

    kind = "csv"

    def convert(self, name: str, content: bytes) -> Builder:
        text, o = content.decode("utf-8-sig", "ignore"), self.options
        meta = o.get("metadata") or {}
        columns, rows = read_sample(text, o.get("delimiter") or detect_delimiter(name, text), o.get("has_header", True), o.get("sample_size", 100))
        if not columns:
            raise ValueError(f"no columns in {name}")
        out = Builder(self.base)
        row_class = meta.get("row_class", o.get("row_class", "Row"))
        owner = out.term(row_class, CLASS, meta.get("title", row_class), meta.get("description", ROW_COMMENT.format(os.path.basename(name))))
        for i, column in enumerate(columns):
            about = metadata_of_column(meta, column, i)
            prop = about.get("name") or column
            declared = about.get("datatype")
            declared = declared.get("base") if isinstance(declared, dict) else declared
            kind = (o.get("type_mapping") or {}).get(column) or declared or infer_type([r[i] for r in rows])
            title = about.get("title") or prop
            me = out.term(sanitize_column(prop), DATATYPE_PROPERTY, title, about.get("description"), owner, XSD + CSV_TYPES.get(str(kind).lower(), "string"))
            if about.get("required"):
                out.require(sanitize_column(prop), me, owner)
        self.stats = {"classes": 1, "datatype_properties": len(columns), "columns": len(columns), "rows_sampled": min(len(rows), o.get("sample_size", 100))}
        return out


# --- JSON Schema --------------------------------------------------------------------------------


class JsonSchemaConverter(Converter):
    """References are JSON pointers into the document, each made into a class once. ``class_scoped``: property names carry their class."""

    kind = "json-schema"

    def convert(self, name: str, content: bytes) -> Builder:
        root = json.loads(content.decode("utf-8-sig"))
        if not isinstance(root, dict):
            raise ValueError(f"{name}: a schema must be an object")
        self.root, self.out, self.done = root, Builder(self.base), {}
        self.schema(root, root.get("title") or self.options.get("root_class") or "Root")
        for part in ("definitions", "$defs"):
            for key in root.get(part) or {}:
                self.reference(f"#/{part}/{key}")
        for key in ((root.get("components") or {}).get("schemas")) or {}:
            self.reference(f"#/components/schemas/{key}")
        self.stats = self.out.counts()
        return self.out

    def pointer(self, ref: str):
        at = self.root
        if ref == "#":
            return at
        if not ref.startswith("#/"):
            return None
        for step in ref[2:].split("/"):
            step = step.replace("~1", "/").replace("~0", "~")
            at = at.get(step) if isinstance(at, dict) else at[int(step)] if isinstance(at, list) and step.isdigit() and int(step) < len(at) else None
            if at is None:
                return None
        return at

    def reference(self, ref: str) -> str:
        if ref not in self.done:
            found, name = self.pointer(ref), ref.rsplit("/", 1)[-1]
            self.done[ref] = self.out.name(name)  # a reference to itself ends here
            if isinstance(found, dict):
                self.done[ref] = self.schema(found, name)
            else:
                self.done[ref] = f"{XSD}string"
        return self.done[ref]

    def schema(self, s, name: str) -> str:
        """The IRI of a class or of an XSD type."""
        if not isinstance(s, dict):
            return f"{XSD}string"
        if "$ref" in s:
            return self.reference(s["$ref"])
        for word, text in VARIANT_COMMENTS.items():
            if word in s:
                return self.combined(s, name, word, text)
        kind = s.get("type")
        if isinstance(kind, list):
            some = [k for k in kind if k != "null"]
            return self.schema({**s, "type": some[0]}, name) if len(some) == 1 else self.variants(s, name, kind)
        if kind == "array":
            items = s.get("items")
            return self.schema(items, name) if isinstance(items, dict) else f"{XSD}string"
        if kind == "object" or "properties" in s:
            return self.object(s, name)
        return XSD + JSON_TYPES.get(kind, "string")

    def object(self, s: dict, name: str) -> str:
        me = self.out.term(name, CLASS, s.get("title", name), s.get("description"))
        required = set(s.get("required") or [])
        members = [(k, v, k in required) for k, v in (s.get("properties") or {}).items()]
        members += [(PATTERN.format(name, sanitize(k)), v, False) for k, v in (s.get("patternProperties") or {}).items()]
        if isinstance(s.get("additionalProperties"), dict):
            members.append((ADDITIONAL.format(name), s["additionalProperties"], False))
        for key, value, needed in members:
            self.property(f"{name}_{key}" if self.options.get("class_scoped") else key, value if isinstance(value, dict) else {}, me, needed)
        return me

    def property(self, name: str, s: dict, owner: str, needed: bool) -> None:
        seen = set()
        target = None
        while "$ref" in s and s["$ref"] not in seen:
            seen.add(s["$ref"])
            target, found = self.reference(s["$ref"]), self.pointer(s["$ref"])
            s = {**(found if isinstance(found, dict) else {}), **{k: v for k, v in s.items() if k != "$ref"}} if found is not None else {k: v for k, v in s.items() if k != "$ref"}
        kinds = s.get("type")
        kinds = [k for k in kinds if k != "null"] if isinstance(kinds, list) else [kinds]
        label = s.get("title", name)
        if "array" in kinds:
            items = s.get("items") if isinstance(s.get("items"), dict) else None
            range_ = None if not items else self.schema(items, items.get("title") or f"{name}Item")
            me = self.out.term(name, OBJECT_PROPERTY, label, s.get("description"), owner, range_)
        elif "object" in kinds or "properties" in s:
            range_ = target or self.object(s, s.get("title") or f"{name}Type")
            me = self.out.term(name, OBJECT_PROPERTY, label, s.get("description"), owner, range_)
        else:
            range_ = XSD + JSON_TYPES.get(kinds[0] if len(kinds) == 1 else "string", "string")
            me = self.out.term(name, DATATYPE_PROPERTY, label, s.get("description"), owner, range_)
        if needed:
            self.out.require(name, me, owner)
        for value in s.get("enum") or []:
            self.out.add(literal(me, COMMENT, ALLOWED.format(value)))

    def combined(self, s: dict, name: str, word: str, text: str | None) -> str:
        parts = s[word]
        me = self.out.term(name, CLASS, s.get("title", name), text.format(len(parts)) if text else s.get("description"))
        kids = [self.schema(p, f"{name}_{word[0].upper()}{word[1:]}_{i}") for i, p in enumerate(parts)]
        for k in kids:
            self.out.add(iri(me, SUBCLASS, k) if word == "allOf" else iri(k, SUBCLASS, me))
        if word == "oneOf":
            self.out.add(*[iri(a, f"{OWL}disjointWith", b) for i, a in enumerate(kids) for b in kids[i + 1 :]])
        return me

    def variants(self, s: dict, name: str, kinds: list[str]) -> str:
        me = self.out.term(name, CLASS, s.get("title", name), UNION_COMMENT.format(", ".join(kinds)))
        for k in kinds:
            self.out.add(iri(me, SUBCLASS, self.schema({**s, "type": k}, VARIANT.format(name, k))))
        return me


# --- XML Schema ---------------------------------------------------------------------------------

_XS = "{http://www.w3.org/2001/XMLSchema}"
_LOCAL = re.compile(r"[^A-Za-z0-9._\-]")


def builtin_range(local: str) -> str | None:
    """A builtin by its own name."""
    n = local.lower()
    if n in ("nonnegativeinteger", "positiveinteger", "negativeinteger", "nonpositiveinteger", "unsignedlong", "unsignedint", "unsignedshort", "unsignedbyte"):
        return "integer"
    known = {"int": "integer", "long": "integer", "short": "integer", "byte": "integer", "float": "decimal", "double": "decimal", "datetime": "dateTime"}
    return known.get(n, GENERIC_TYPES.get(n) if n in ("integer", "decimal", "date", "time", "boolean", "anyuri", "string") else None)


def simple_range(name: str) -> str:
    """A user type by what its name holds."""
    n = name.lower()
    return next((kind for kind, pattern in SIMPLE_TYPE_RULES if re.search(pattern, n)), "string")


class StayingTool:
    """A command that stays and converts file after file: it reads a line with a number of bytes and then a schema of so many, answers in the same form, and ends with its input.

    An answer that doesn't begin with a number means that it can't convert the file. A tool that ended, or did not answer in time, is started again for the next file.
    """

    def __init__(self, command: list[str], timeout: float = 300):
        self.command, self.timeout, self.process = command, timeout, None

    def ask(self, content: bytes) -> str:
        if self.process is None:
            self.process = subprocess.Popen(self.command, stdin=subprocess.PIPE, stdout=subprocess.PIPE)
        p, answered = self.process, False
        late = threading.Timer(self.timeout, p.kill)
        late.start()
        try:
            p.stdin.write(b"%d\n" % len(content) + content)
            p.stdin.flush()
            line = p.stdout.readline()
            made = p.stdout.read(size := int(line)) if line.strip().isdigit() else None
            answered = line.endswith(b"\n") and (made is None or len(made) == size)
            if not answered or made is None:
                raise ValueError("no answer")
            return made.decode()
        finally:
            late.cancel()
            if not answered:
                self.close()

    def close(self) -> None:
        p, self.process = self.process, None
        if p is not None:
            p.kill()
            p.communicate()


class XmlSchemaConverter(Converter):
    """complexType: class; its base: superclass; attributes: datatype properties; child elements and global elements: object properties.

    With the option ``command`` (a program and its arguments, which reads a schema and writes Turtle or RDF/XML) that tool is asked first, for at most
    ``timeout`` seconds; where it isn't there or fails, the conversion is done here. With ``stays`` the tool is started once for many files (``StayingTool``).
    """

    kind = "xsd"

    def external(self, content: bytes) -> Builder | None:
        from meshwright.sources import rdf

        if shutil.which(self.options["command"][0]) is None:  # no process is started in vain for each file
            return None
        tool = self.options.get("tool") or StayingTool(self.options["command"], self.options.get("timeout", 300))
        try:
            if self.options.get("stays"):
                made = tool.ask(content)
            else:
                made = subprocess.run(tool.command, input=content, capture_output=True, check=True, timeout=tool.timeout).stdout.decode()
            out = Builder(self.base)
            out.add(*rdf.parse_text(made, "xml" if made.lstrip().startswith("<?xml") else "made.ttl"))
            return out
        except (OSError, ValueError, ET.ParseError, subprocess.SubprocessError):
            return None
        finally:
            if "tool" not in self.options:
                tool.close()

    def convert(self, name: str, content: bytes) -> Builder:
        if self.options.get("command") and (made := self.external(content)) is not None:
            self.stats = made.counts()
            return made
        # prefixes are needed to resolve QNames; ElementTree gives them as events
        prefixes, root = {}, None
        for event, x in ET.iterparse(io.BytesIO(content), ("start-ns", "start")):
            if event == "start-ns":
                prefixes.setdefault(x[0], x[1])
            elif root is None:
                root = x
        if root is None or root.tag != f"{_XS}schema":
            raise ValueError(f"{name}: no XML Schema")
        self.prefixes, self.ns, self.out, self.done = prefixes, root.get("targetNamespace") or "", Builder(self.base), set()
        self.types = {e.get("name"): e for e in root if e.tag in (f"{_XS}complexType", f"{_XS}simpleType")}
        self.groups = {(e.tag, e.get("name")): e for e in root if e.tag in (f"{_XS}group", f"{_XS}attributeGroup", f"{_XS}element", f"{_XS}attribute")}
        for e in root:
            if e.tag == f"{_XS}complexType":
                self.complex(e, e.get("name"))
            elif e.tag == f"{_XS}element":
                self.element(e, None)
        self.stats = self.out.counts()
        return self.out

    def iri(self, ns: str | None, local: str) -> str:
        base = ns or self.base
        return base + ("" if base[-1] in "/#" else "#") + _LOCAL.sub("_", re.sub(r"^\{[^}]*\}", "", local) or "Unnamed")

    def qname(self, text: str) -> tuple[str, str]:
        prefix, _, local = text.rpartition(":")
        return self.prefixes.get(prefix, "" if prefix else self.ns), local

    def range_of(self, ref: str | None, inline: ET.Element | None = None, hint: str = "") -> str:
        """IRI of a named or inline type: a class for complex types, else an XSD type."""
        if ref:
            ns, local = self.qname(ref)
            if ns == _XS[1:-1]:
                return XSD + (builtin_range(local) or simple_range(local))
            found = self.types.get(local)
            if found is None:
                return self.iri(ns, local) if ns != self.ns else XSD + simple_range(local)
            if found.tag == f"{_XS}complexType":
                return self.complex(found, local)
            return self.simple(found, local)
        if inline is not None:
            return self.complex(inline, hint) if inline.tag == f"{_XS}complexType" else self.simple(inline, hint)
        return f"{XSD}string"

    def simple(self, e: ET.Element, name: str, above: tuple = ()) -> str:
        r = e.find(f"{_XS}restriction")
        if r is not None and r.get("base") and id(e) not in above:  # a type that restricts itself ends here
            ns, local = self.qname(r.get("base"))
            if ns == _XS[1:-1]:
                return XSD + (builtin_range(local) or simple_range(local))
            if (found := self.types.get(local)) is not None:
                return self.simple(found, local, (*above, id(e)))
        return XSD + simple_range(name)

    def complex(self, e: ET.Element, name: str) -> str:
        me = self.iri(self.ns, name)
        if id(e) in self.done:
            return me
        self.done.add(id(e))
        self.out.add(iri(me, TYPE, CLASS), literal(me, LABEL, name))
        for way in ("complexContent", "simpleContent"):
            for how in ("extension", "restriction"):
                inner = e.find(f"{_XS}{way}/{_XS}{how}")
                if inner is not None:
                    if inner.get("base"):
                        ns, local = self.qname(inner.get("base"))
                        self.out.add(iri(me, SUBCLASS, self.iri(ns, local)))
                    self.members(inner, me)
        self.members(e, me)
        return me

    def members(self, e: ET.Element, me: str, above: tuple = ()) -> None:
        for c in e:
            if c.tag == f"{_XS}attribute":
                c = self.groups.get((c.tag, self.qname(c.get("ref"))[1]), c) if c.get("ref") else c
                if c.get("name"):
                    p = self.iri(None, c.get("name"))
                    inline = c.find(f"{_XS}simpleType")
                    self.out.add(iri(p, TYPE, DATATYPE_PROPERTY), iri(p, DOMAIN, me), literal(p, LABEL, c.get("name")), iri(p, RANGE, self.range_of(c.get("type"), inline, c.get("name"))))
            elif c.tag == f"{_XS}element":
                self.element(c, me)
            elif c.tag in (f"{_XS}sequence", f"{_XS}choice", f"{_XS}all"):
                self.members(c, me, above)
            elif c.tag in (f"{_XS}group", f"{_XS}attributeGroup") and c.get("ref"):
                found = self.groups.get((c.tag, self.qname(c.get("ref"))[1]))
                if found is not None and id(found) not in above:  # a group that holds itself ends here
                    self.members(found, me, (*above, id(found)))

    def element(self, e: ET.Element, owner: str | None) -> None:
        if e.get("ref"):
            e = self.groups.get((e.tag, self.qname(e.get("ref"))[1]), e)
        name = e.get("name")
        if not name:
            return
        inline = e.find(f"{_XS}complexType")
        inline = e.find(f"{_XS}simpleType") if inline is None else inline
        p = self.iri(self.ns, name)
        self.out.add(iri(p, TYPE, OBJECT_PROPERTY), literal(p, LABEL, name))
        if owner:
            self.out.add(iri(p, DOMAIN, owner))
        self.out.add(iri(p, RANGE, self.range_of(e.get("type"), inline, name)))


# --- running ------------------------------------------------------------------------------------

#: Triples that a task of conversions gives out at once.
ROWS = 4096
KIND_OF_EXTENSION = {"csv": "csv", "tsv": "csv", "json": "json-schema", "xsd": "xsd"}


def load_csvw(path: str, explicit: str | None = None) -> dict:
    """The table's description: a given file, else the one beside it; empty if there is none or it can't be read."""
    try:
        with open(explicit or f"{path}-metadata.json", encoding="utf-8") as f:
            return json.load(f)
    except (OSError, ValueError):
        return {}


def convert_file(spark: SparkSession, path: str, kind: str | None = None, base: str = SCHEMA_BASE, **options) -> tuple[DataFrame, dict]:
    """(triples, statistics) of one schema file on the driver."""
    kind = kind or KIND_OF_EXTENSION.get(path.rsplit(".", 1)[-1].lower(), "")
    if kind == "csv" and "metadata" not in options:
        options["metadata"] = load_csvw(path, options.pop("metadata_file", None))
    c = converter(kind, base=base, **options)
    with open(path, "rb") as f:
        rows = list(c.convert(path, f.read()).rows)
    return spark.createDataFrame(rows, TRIPLES), c.stats


def convert_contents(files: DataFrame, kind: str, base: str = SCHEMA_BASE, strict: bool = True, **options) -> DataFrame:
    """Triples of ``files(path, content)``, united as a set. Not strict: files that can't be converted give none.

    With a ``command`` each file starts a process (with ``stays``, each task), so files are dealt out anew to all cores, however few partitions they come in.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, more = [], {}
        if options.get("command"):
            more["tool"] = StayingTool(options["command"], options.get("timeout", 300))
        try:
            for batch in batches:
                for name, content in zip(batch["path"], batch["content"]):
                    try:
                        rows += converter(kind, base=base, **options, **more).convert(name, bytes(content)).rows
                    except (ValueError, ET.ParseError):
                        if strict:
                            raise
                    if len(rows) >= ROWS:
                        yield pd.DataFrame(rows, columns=COLUMNS, dtype=object)
                        rows = []
            yield pd.DataFrame(rows, columns=COLUMNS, dtype=object)
        finally:
            if more:
                more["tool"].close()

    files = files.select("path", "content")
    if options.get("command"):
        files = files.repartition(4 * files.sparkSession.sparkContext.defaultParallelism)
    return files.mapInPandas(run, "s string, p string, o string, o_kind string, o_datatype string, o_lang string").distinct()


def convert_files(spark: SparkSession, paths: str | list[str], kind: str, base: str = SCHEMA_BASE, strict: bool = True, **options) -> DataFrame:
    return convert_contents(spark.read.format("binaryFile").load(paths), kind, base, strict, **options)


def report(stats: dict, title: str = "Conversion report") -> str:
    return "\n".join([title, "=" * len(title), *(f"{k.replace('_', ' ').title()}: {v}" for k, v in stats.items())]) + "\n"
