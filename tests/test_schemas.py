import json
import sys

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meshwright.functions import terms as fn
from meshwright.sources import schemas as sc
from meshwright.vocab import CLASS, COMMENT, DATATYPE_PROPERTY, DOMAIN, LABEL, OBJECT_PROPERTY, OWL, RANGE, SUBCLASS, TYPE, XSD


def rows(kind, content, name="f", **options):
    c = sc.converter(kind, base="http://b/", **options)
    text = json.dumps(content) if isinstance(content, dict) else content
    return {r[:3] for r in c.convert(name, text.encode()).rows}, c.stats


@given(st.text())
def test_sanitised_names_are_safe(text):
    s = sc.sanitize(text)
    assert not set(s) & set(fn.UNSAFE) and not s[:1].isdigit()


def test_name_functions(spark):
    one = lambda c, *v: [r[0] for r in spark.createDataFrame([(x,) for x in v], "x string").select(c(F.col("x"))).collect()]
    assert one(fn.local_name, "{http://example.org/schema}Person", "", "{ns}") == ["Person", "Unnamed", "Unnamed"]
    assert one(fn.safe_local, "My-Type", "My.Type", "My Type", "My@Type", "{x}My Type!") == ["My-Type", "My.Type", "My_Type", "My_Type", "My_Type_"]
    assert one(lambda c: fn.iri_for(c, F.lit("Person"), "http://base/"), "http://e/schema", "http://e/", "http://e#", "") == ["http://e/schema#Person", "http://e/Person", "http://e#Person", "http://base/Person"]
    assert one(fn.sanitize_name, "{n}x:1a-b.c", "ok") == ["n1a_b_c", "ok"] and one(fn.sanitize_column_name, "  ", " a b ") == ["unnamed_column", "a_b"]
    assert one(fn.name_of_location, "http://e/x.owl", "/a/b.c.ttl", "plain") == ["x", "b.c", "plain"] and one(fn.display_name, "http://e/a#B", "http://e/C") == ["B", "C"]
    assert one(fn.stat_title, "object_properties") == ["Object Properties"] and one(fn.valid_identifier, "ok", " ", "a/b", None) == [True, False, False, False]


VALUES = {"boolean": ["Yes", "0", " t "], "integer": ["1_000", "-3", "+4"], "decimal": ["1.5", "1e5", "nan", ".5", "2."], "date": ["2024-01-02", "12/1999"], "string": ["a", "1"]}


def test_type_inference_of_samples_and_tables_agree(spark):
    for kind, values in VALUES.items():
        assert sc.infer_type([*values, "", "  "]) == kind
    wide = [(kind, *([None] * 0), v) for kind, values in VALUES.items() for v in values]
    df = spark.createDataFrame(wide, "kind string, v string").groupBy().pivot("kind", list(VALUES)).agg(F.collect_list("v"))
    for kind in VALUES:
        t = df.select(F.explode(kind).alias("v")).unionByName(spark.createDataFrame([("",), (None,)], "v string"))
        assert sc.infer_types(t).first().type == kind
    assert sc.infer_type([]) == "string" and sc.infer_types(spark.createDataFrame([(None,)], "v string")).first().type == "string"


def test_tables():
    meta = {"title": "Things", "columns": [{"name": "id", "required": True, "datatype": {"base": "integer"}}, {"titles": ["Full name"], "name": "fullName", "description": "who"}]}
    got, stats = rows("csv", "id;Full name;ok\n1;Ann;yes\n2;Bob;no\nragged;row\n", "t.csv", metadata=meta, delimiter=";")
    assert ("http://b/Row", LABEL, "Things") in got and ("http://b/id", RANGE, f"{XSD}integer") in got and ("http://b/ok", RANGE, f"{XSD}boolean") in got
    assert ("http://b/fullName", COMMENT, "who") in got and ("http://b/Row", SUBCLASS, "http://b/id_Required_Restriction") in got
    assert stats == {"classes": 1, "datatype_properties": 3, "columns": 3, "rows_sampled": 2}
    assert sc.read_sample("a,b\n1,2\n", ",", False, 10) == (["column_0", "column_1"], [["a", "b"], ["1", "2"]])
    assert sc.detect_delimiter("x.tsv", "a,b") == "\t" and sc.detect_delimiter("x.csv", "one") == ","
    with pytest.raises(ValueError):
        rows("csv", "")


def test_json_schema():
    schema = {
        "title": "User", "type": "object", "required": ["id"],
        "properties": {"id": {"type": ["string", "null"]}, "a-b": {"type": "number", "enum": [1, 2]}, "address": {"$ref": "#/definitions/Address"}, "work": {"$ref": "#/definitions/Address"}, "tags": {"type": "array", "items": {"type": "integer"}}, "friends": {"type": "array", "items": {"$ref": "#"}}, "any": True},
        "patternProperties": {"^x": {"type": "string"}}, "additionalProperties": {"type": "boolean"},
        "definitions": {"Address": {"type": "object", "properties": {"next": {"$ref": "#/definitions/Address"}}}, "Either": {"oneOf": [{"type": "object"}, {"type": "object"}]}, "All": {"allOf": [{"$ref": "#/definitions/Address"}]}},
    }
    got, stats = rows("json-schema", schema)
    has = lambda *t: t in got
    assert has("http://b/User", TYPE, CLASS) and has("http://b/id", RANGE, f"{XSD}string") and has("http://b/User", SUBCLASS, "http://b/id_Required_Restriction")
    assert has("http://b/a_b", COMMENT, "Allowed value: 1") and has("http://b/address", RANGE, "http://b/Address") and has("http://b/work", RANGE, "http://b/Address") and has("http://b/next", DOMAIN, "http://b/Address")
    assert has("http://b/tags", RANGE, f"{XSD}integer") and has("http://b/tags", TYPE, OBJECT_PROPERTY) and has("http://b/friends", TYPE, OBJECT_PROPERTY)
    assert has("http://b/Either_OneOf_0", f"{OWL}disjointWith", "http://b/Either_OneOf_1") and has("http://b/All", SUBCLASS, "http://b/Address")
    assert has("http://b/User_AdditionalProperty", TYPE, DATATYPE_PROPERTY) and stats["classes"] >= 5
    with pytest.raises(ValueError):
        sc.converter("json-schema").convert("x", b"[]")


XSD_TEXT = """<?xml version="1.0"?><xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema" xmlns:t="http://t/" targetNamespace="http://t/">
<xs:complexType name="Base"><xs:attribute name="sku" type="xs:string" use="required"/></xs:complexType>
<xs:complexType name="Product"><xs:complexContent><xs:extension base="t:Base"><xs:sequence>
 <xs:element name="price" type="xs:decimal"/><xs:element name="part" type="t:Product" minOccurs="0"/><xs:element name="point" type="t:PointType"/>
 <xs:element name="inner"><xs:complexType><xs:all><xs:element name="when" type="xs:dateTime"/></xs:all></xs:complexType></xs:element></xs:sequence></xs:extension></xs:complexContent></xs:complexType>
<xs:simpleType name="PointType"><xs:restriction base="xs:string"/></xs:simpleType>
<xs:element name="Catalog" type="t:Product"/></xs:schema>"""


def test_xml_schema():
    got, stats = rows("xsd", XSD_TEXT)
    has = lambda *t: t in got
    assert has("http://t/Product", SUBCLASS, "http://t/Base") and has("http://b/sku", DOMAIN, "http://t/Base") and has("http://b/sku", RANGE, f"{XSD}string")
    assert has("http://t/price", RANGE, f"{XSD}decimal") and has("http://t/part", RANGE, "http://t/Product") and has("http://t/point", RANGE, f"{XSD}string")
    assert has("http://t/inner", RANGE, "http://t/inner") and has("http://t/when", RANGE, f"{XSD}dateTime") and has("http://t/Catalog", TYPE, OBJECT_PROPERTY)
    assert stats == {"classes": 3, "object_properties": 6, "datatype_properties": 1}
    assert rows("xsd", '<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"/>')[1]["classes"] == 0
    with pytest.raises(ValueError):
        rows("xsd", "<a/>")


def test_many_files(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.xsd").write_text(XSD_TEXT)
    (tmp_path / "bad.xsd").write_text("<a>")
    one, _ = sc.convert_file(spark, str(tmp_path / "0.xsd"), base="http://b/")
    assert sc.convert_files(spark, f"{tmp_path}/[0-9].xsd", "xsd", "http://b/").count() == one.count()
    assert sc.convert_files(spark, f"{tmp_path}/*.xsd", "xsd", "http://b/", strict=False).count() == one.count()
    with pytest.raises(ValueError):
        sc.converter("nope")
    assert sc.report({"object_properties": 2}).endswith("Object Properties: 2\n")


def test_files_for_a_tool_are_dealt_to_all_cores(spark):
    tool = [sys.executable, "-c", "import os, sys; sys.stdin.read(); print(f'<urn:by#{os.getppid()}> <urn:p> <urn:o> .')"]
    files = spark.createDataFrame([(f"x{i}.xsd", f"<!-- {i} -->".encode()) for i in range(64)], "path string, content binary").coalesce(1)
    assert sc.convert_contents(files, "xsd", command=tool).where("p = 'urn:p'").count() > 1  # asked by several workers


STAYING = """import sys, os, time
i, o = sys.stdin.buffer, sys.stdout.buffer
for n in i:
    x = i.read(int(n))
    if b'name="dies"' in x: sys.exit(1)
    if b'name="late"' in x: time.sleep(60)
    made = b'cannot\\n' if b'name="not"' in x else b'<urn:by#%d> a <urn:x> .' % os.getpid()
    o.write(made if made[:1] == b'c' else b'%d\\n%s' % (len(made) + (b'name="cut"' in x), made)); o.flush()
    if b'name="cut"' in x: sys.exit(0)
"""


def test_a_tool_that_stays(spark):
    text = lambda name: f'<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema" targetNamespace="urn:s#"><xs:complexType name="{name}"/></xs:schema>'
    command = [sys.executable, "-c", STAYING]
    tool = sc.StayingTool(command, 2)
    ask = lambda name: {r[0] for r in sc.converter("xsd", command=command, stays=True, tool=tool).convert("f", text(name).encode()).rows if r[1] == TYPE and r[0][:4] == "urn:"}
    first = ask("a")
    assert first == ask("b") == ask("é" * 100_000) and "urn:by#" in min(first)  # one process
    assert "urn:s#not" in ask("not") and ask("c") == first  # the built-in converter steps in
    assert "urn:s#dies" in ask("dies") and (second := ask("d")) != first
    assert "urn:s#late" in ask("late") and (third := ask("e")) != second
    assert "urn:s#cut" in ask("cut") and ask("f") != third
    tool.close()
    files = spark.createDataFrame([(f"x{i}.xsd", text(f"n{i}").encode()) for i in range(200)], "path string, content binary")
    assert 0 < sc.convert_contents(files, "xsd", command=command, stays=True).where("o = 'urn:x'").count() < 100  # a process a task
    assert rows("xsd", text("a"), command=command, stays=True)[1] is not None


def test_a_tool_that_is_missing_starts_no_process(monkeypatch):
    monkeypatch.setattr(sc.subprocess, "run", lambda *a, **k: pytest.fail("started"))
    got, _ = rows("xsd", '<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema" targetNamespace="urn:s#"><xs:complexType name="T"/></xs:schema>', command=["no-such-tool"])
    assert ("urn:s#T", TYPE, CLASS) in got


def test_deep_and_circular_groups_and_types():
    depth = 120
    groups = "".join(f'<xs:attributeGroup name="g{i}"><xs:attributeGroup ref="g{i + 1}"/></xs:attributeGroup>' for i in range(depth))
    types = "".join(f'<xs:simpleType name="t{i}"><xs:restriction base="t{i + 1}"/></xs:simpleType>' for i in range(depth))
    text = f"""<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">{groups}{types}<xs:simpleType name="t{depth}"><xs:restriction base="xs:decimal"/></xs:simpleType>
    <xs:simpleType name="loop"><xs:restriction base="loop"/></xs:simpleType>
    <xs:attributeGroup name="g{depth}"><xs:attribute name="last" type="t0"/><xs:attribute name="odd" type="loop"/><xs:attributeGroup ref="g0"/></xs:attributeGroup>
    <xs:complexType name="T"><xs:attributeGroup ref="g0"/></xs:complexType></xs:schema>"""
    rows = sc.converter("xsd").convert("x.xsd", text.encode()).rows
    found = {(r[0].rsplit("/", 1)[-1].rsplit("#", 1)[-1], r[2]) for r in rows if r[1] == RANGE}
    assert found == {("last", f"{XSD}decimal"), ("odd", f"{XSD}string")}
