import random

import pytest

from meshwright.operators import matching, reasoning, validation
from meshwright.operators import triples as tr
from meshwright.operators.triples import graph, iri, literal
from meshwright.plans import catalogue
from meshwright.sources import meta, rdf
from meshwright.vocab import CLASS, COMMENT, DATATYPE_PROPERTY, DOMAIN, LABEL, META, OBJECT_PROPERTY, OWL, RANGE, RDFS, SUBCLASS, TRIPLES, TYPE


def edges(spark, pairs):
    return graph(spark, [iri(a, SUBCLASS, b) for a, b in pairs])


def nodes(df):
    return {r.node for r in df.collect()}


def test_cycles(spark):
    g = edges(spark, [("a", "b"), ("b", "a"), ("b", "c"), ("d", "d")])
    assert {r.s + r.o for r in reasoning.transitive_closure(g).collect()} == {"aa", "ab", "ac", "ba", "bb", "bc", "dd"}
    assert nodes(reasoning.superclasses(g, "a")) == {"b", "c"} and nodes(reasoning.subclasses(g, "a")) == {"b"} and nodes(reasoning.superclasses(g, "d")) == set()
    assert nodes(reasoning.superclasses(g, "a", True)) == {"b"}
    assert reasoning.is_subclass_of(g, "a", "a") and not reasoning.is_subclass_of(g, "a", "a", strict=True) and reasoning.is_subclass_of(g, "a", "c")
    assert reasoning.transitive_closure(g.limit(0)).count() == 0


def test_lowest_common_ancestor(spark):
    g = edges(spark, [("x", "m"), ("y", "m"), ("m", "top"), ("z", "top"), ("p", "l1"), ("p", "l2"), ("q", "l1"), ("q", "l2")])
    pairs = spark.createDataFrame([("x", "y"), ("x", "z"), ("p", "q"), ("x", "p"), ("m", "x")], "c1 string, c2 string")
    got = {(r.c1, r.c2): r.lca for r in reasoning.lowest_common_ancestors(reasoning.proper_ancestors(g), pairs).collect()}
    assert got == {("x", "y"): "m", ("x", "z"): "top", ("p", "q"): "l1", ("x", "p"): None, ("m", "x"): "top"}


def test_pairs_by_key_equal_single_pairs(spark, monkeypatch):
    monkeypatch.setattr(reasoning, "MEMBERS", 2)
    rng = random.Random(4)
    up = [(f"n{i}", f"n{rng.randrange(max(1, i - 9), i + 1)}") for i in range(1, 60) for _ in range(2)] + [("n5", "n9"), ("n9", "n5"), ("x", "x")]
    ancestors = reasoning.proper_ancestors(edges(spark, up))
    keyed = lambda names, c: spark.createDataFrame([(rng.randrange(4), rng.choice(names)) for _ in range(60)] + [(None, "n1"), (1, None), (7, "x"), (8, "alone")], f"k int, {c} string")
    names = [f"n{i}" for i in range(60)]
    left, right = keyed(names, "c1"), keyed(names[30:], "c2")
    pairs = left.join(right, "k").select("c1", "c2")
    got = reasoning.KeyedPairs(ancestors, left, right)
    flat = lambda df: sorted(tuple(map(str, r)) for r in df.collect())
    assert flat(got.common_ancestors()) == flat(reasoning.common_ancestors(ancestors, pairs))
    assert flat(got.members(got.met.select("g1", "g2", "n", "common"), "common", 10).select("c1", "c2")) == flat(pairs.where("c1 is not null and c2 is not null").distinct())
    assert flat(got.lowest_common_ancestors(ancestors)) == flat(reasoning.lowest_common_ancestors(ancestors, pairs.where("c1 is not null and c2 is not null")))


@pytest.mark.parametrize("name", ["common_ancestors", "lowest_common_ancestor"])
def test_pairs_of_classes_are_not_shuffled(spark, name):
    plan = catalogue.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(c1" not in plan and "hashpartitioning(c2" not in plan


def test_golden_counts(spark):
    g = meta.GenericOntology(spark).graph()
    assert g.count() == 92 + 8 or g.count() == 100
    assert meta.alignment_graph(spark).count() == 84
    assert meta.merge_with_upper_ontology(g, "BFO").count() == 100 + 14
    kinds = [r.kind for r in reasoning.applicable_properties(g).where(f"cls = '{META}Agent'").collect()]
    assert (kinds.count("object"), kinds.count("datatype")) == (7, 3)
    lines = reasoning.print_hierarchy(g).split("\n")
    assert lines == ["- Entity", "  - Agent", "  - Contract", "  - Event", "  - Location", "  - Metric", "  - Regulation"]


def test_hierarchy_of_a_cycle_ends(spark):
    g = edges(spark, [("b", "a"), ("a", "b")])
    assert reasoning.print_hierarchy(g, "a") == "- a\n  - b"


def test_union_is_a_set_and_classes_are_added_once(spark):
    a = graph(spark, [iri("x", TYPE, CLASS), literal("x", LABEL, "X")])
    b = graph(spark, [iri("y", TYPE, CLASS)])
    assert tr.union(a, b, a).exceptAll(tr.union(b, a)).isEmpty() and tr.union(a, a).count() == 2
    once = tr.add_domain_classes(a, ["n"])
    assert tr.add_domain_classes(once, ["n"]).count() == once.count() == 4
    assert tr.properties(graph(spark, [iri("p", TYPE, OBJECT_PROPERTY), iri("p", TYPE, DATATYPE_PROPERTY)])).first().kind == "object"
    with pytest.raises(ValueError):
        tr.select_pattern(a, [("?a", TYPE, CLASS), ("?b", LABEL, "?c")])


def test_validation(spark):
    g = graph(spark, [iri("A", TYPE, CLASS), iri("B", SUBCLASS, "A"), iri("p", DOMAIN, "Q"), iri("A", f"{OWL}complementOf", "B"), iri("i", TYPE, "A"), iri("i", TYPE, "B")])
    r = validation.validate(g, "EL")
    assert not r.is_valid and {x.rule for x in r.findings.collect()} == {"undeclared_class", "undeclared_property", "undeclared_domain", "profile_el"}
    assert validation.validate(g, "RL").is_valid and not validation.validate(g, "DL").is_valid and not validation.is_consistent(g)
    with pytest.raises(ValueError):
        validation.validate(g, "XX")


def test_inference_rules(spark):
    rows = [iri("A", SUBCLASS, "B"), iri("B", f"{OWL}equivalentClass", "C"), iri("i", TYPE, "A"), iri("p", DOMAIN, "D"), iri("p", RANGE, "E"), iri("i", "p", "j"), iri("p", f"{OWL}inverseOf", "q"), iri("t", TYPE, f"{OWL}TransitiveProperty"), iri("1", "t", "2"), iri("2", "t", "3"), iri("3", "t", "4"), iri("p", f"{RDFS}subPropertyOf", "r")]
    got = {(x.s, x.p, x.o) for x in reasoning.materialize(graph(spark, rows)).collect()}
    assert {("i", TYPE, "C"), ("i", TYPE, "D"), ("j", TYPE, "E"), ("j", "q", "i"), ("1", "t", "4"), ("i", "r", "j")} <= got


TTL = """@prefix ex: <http://e/> . @prefix owl: <http://www.w3.org/2002/07/owl#> .
@prefix rdfs: <http://www.w3.org/2000/01/rdf-schema#> . # a comment
ex:A a owl:Class ; rdfs:label "A \\"q\\" \\u00e9"@en , 'two' ; rdfs:comment \"\"\"long
text\"\"\" .
ex:B rdfs:subClassOf ex:A , [ a owl:Restriction ; owl:minCardinality 1 ] ; ex:n 1.5 , 2e3 , true , "x"^^ex:t ; ex:l ( ex:A ex:B ) .
"""


def test_rdf_round_trips(spark, tmp_path):
    (tmp_path / "a.ttl").write_text(TTL)
    g = rdf.read(spark, str(tmp_path / "a.ttl")).cache()
    assert g.count() == 4 + 2 + 2 + 4 + 1 + 4
    plain = lambda df: {tuple(r) for r in df.where("s not like '\\\\_:%' and o_kind <> 'bnode'").collect()}
    assert ("http://e/A", LABEL, 'A "q" é', "literal", None, "en") in plain(g)
    for fmt, name in (("turtle", "b.ttl"), ("xml", "b.owl"), ("nt", "b.nt")):
        back = rdf.read(spark, rdf.serialize(g, str(tmp_path / name), fmt))
        if fmt == "nt":  # escapes cover newlines
            assert plain(back) == plain(g)
        assert back.count() == g.count() and plain(back) == plain(g), fmt
    rdf.write_ntriples(g, str(tmp_path / "parts"))
    assert rdf.read_ntriples(spark, str(tmp_path / "parts")).count() == g.count()
    (tmp_path / "bad.ttl").write_text("ex:A a")
    with pytest.raises(Exception):
        rdf.read(spark, str(tmp_path / "bad.ttl")).collect()
    assert rdf.read(spark, str(tmp_path / "bad.ttl"), strict=False).count() == 0


def test_providers_and_registry(spark, tmp_path):
    (tmp_path / "FND.ttl").write_text(f"<{meta.FINANCIAL_BASE}X> a <{CLASS}> ; <{COMMENT}> \"about X\" .")
    (tmp_path / "my.ttl").write_text(f"<http://e/Y> a <{CLASS}> ; <{LABEL}> \"Y\" ; <{SUBCLASS}> <http://e/Z> .")
    r = meta.Registry()
    fin = r.create(spark, "financial", cache_dir=str(tmp_path), modules=("FND",))
    own = r.create(spark, "custom", path=str(tmp_path / "my.ttl"))
    assert own.name == "my" and {x.s for x in fin.alignment_targets().collect()} == {f"{meta.FINANCIAL_BASE}X"}
    assert fin.describe(f"{meta.FINANCIAL_BASE}X") == "about X" and own.describe("http://e/Y") == "Y" and own.top_level_classes().count() == 0
    both = r.create(spark, "composite", providers=[{"type": "custom", "options": {"path": str(tmp_path / "my.ttl")}}, fin])
    assert both.graph().count() == 5 and both.alignment_targets().count() == 2
    rows = matching.empty_mappings(spark).unionByName(spark.createDataFrame([("s", f"{meta.FINANCIAL_BASE}X", "p", 1.0, "m", None, 1), ("s", "q", "p", 1.0, "m", None, 2)], matching.MAPPINGS))
    assert sorted(x.valid for x in fin.validate_alignments(rows).collect()) == [False, True]
    assert {x.valid for x in both.validate_alignments(rows).collect()} == {True}
    with pytest.raises(ValueError):
        r.create(spark, "financial", cache_dir=str(tmp_path), modules=("NOPE",))
    with pytest.raises(ValueError):
        r.get("nope")
    with pytest.raises(TypeError):
        r.register("x", int)
    r.register("mine", meta.GenericOntology)
    with pytest.raises(ValueError):
        r.register("mine", meta.GenericOntology)
    r.unregister("mine")
    assert not r.is_registered("mine") and r.list() == ["composite", "custom", "financial", "generic"]


def test_parallel_matchers_report_failures(spark):
    class Broken(matching.Matcher):
        def align(self, source, target):
            raise RuntimeError("no")

    g = meta.GenericOntology(spark).graph()
    out = matching.run_alignment_parallel(g, g, [matching.LexicalExact(), Broken()])
    assert [r.success for r in out] == [True, False] and out[1].error == "no" and matching.all_mappings(out).count() == 21
    assert matching.selected(["lexicalexact", "nope"])[1] == ["nope"]


def _labels(spark, names, prefix):
    rows = [t for i, n in enumerate(names) for t in ((f"{prefix}{i}", TYPE, CLASS, "iri"), (f"{prefix}{i}", LABEL, n, "literal"))]
    return spark.createDataFrame([(*r, None, None) for r in rows], TRIPLES)


@pytest.mark.parametrize("threshold", [0.8, 0.6, 0.9, 1.0])
def test_edit_distance_finds_all_pairs(spark, threshold):
    from meshwright.operators.matching import EditDistance

    rng = random.Random(3)
    names = ["".join(rng.choices("abc", k=rng.randint(1, 9))) for _ in range(90)] + ["total", "order", "abcde"]
    other = ["".join(rng.choices("abc", k=rng.randint(1, 9))) for _ in range(90)] + ["tokal", "orler", "abxde", "abcxde"]

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            row = following(row, x, b, i)
        return row[-1]

    def following(row, x, b, i):
        out = [i + 1]
        for j, y in enumerate(b):
            out.append(min(out[-1] + 1, row[j + 1] + 1, row[j] + (x != y)))
        return out

    want = {(f"a:{i}", f"b:{j}") for i, a in enumerate(names) for j, b in enumerate(other) if 1 - distance(a, b) / max(len(a), len(b)) >= threshold - 1e-9}
    got = {(r.subject_id, r.object_id) for r in EditDistance(threshold).align(_labels(spark, names, "a:"), _labels(spark, other, "b:")).collect()}
    assert got == want


@pytest.mark.parametrize("threshold", [0.5, 0.34, 0.75, 1.0])
def test_shared_words_find_all_pairs(spark, threshold):
    from meshwright.operators.matching import TokenJaccard

    rng = random.Random(5)
    make = lambda n: [" ".join(rng.choices("nation a b c d e f".split(), [5, 1, 1, 1, 1, 1, 1], k=rng.randint(1, 5))) for _ in range(n)]
    a, b = make(60), make(60)
    score = lambda x, y: len(set(x.split()) & set(y.split())) / len(set(x.split()) | set(y.split()))
    want = {(f"a:{i}", f"b:{j}") for i, x in enumerate(a) for j, y in enumerate(b) if score(x, y) >= threshold}
    assert {(r.subject_id, r.object_id) for r in TokenJaccard(threshold).align(_labels(spark, a, "a:"), _labels(spark, b, "b:")).collect()} == want


def test_long_ntriples_and_malformed_lines(spark):
    text = 'a\\"' * 300_000
    lines = spark.createDataFrame([(f'<urn:a> <urn:p> "{text}" .',), ("_:" + "b." * 50_000 + "c <urn:p> _:" + "d." * 50_000 + "e .",), ("<urn:a> nonsense",)], "value string")
    got = rdf.parse_ntriples(lines).collect()
    assert len(got) == 2 and max(len(r.o) for r in got if r.o_kind == "literal") == 600_000
    with pytest.raises(Exception, match="unexpected line"):
        rdf.parse_ntriples(lines, strict=True).collect()


def test_deep_hierarchies_are_whole_or_an_error(spark):
    rows = [(f"n{i + 1:04d}", SUBCLASS, f"n{i:04d}", "iri", None, None) for i in range(30)]
    g = spark.createDataFrame(rows, TRIPLES)
    assert reasoning.hierarchy_lines(g, "n0000").count() == 31
    with pytest.raises(RuntimeError, match="deeper"):
        reasoning.hierarchy_lines(g, "n0000", max_depth=10)
    diamond = [("b", SUBCLASS, "a"), ("c", SUBCLASS, "a"), ("d", SUBCLASS, "b"), ("d", SUBCLASS, "c")]
    g = spark.createDataFrame([(*r, "iri", None, None) for r in diamond], TRIPLES)
    assert reasoning.hierarchy_lines(g, "a").count() == 5 and reasoning.hierarchy_lines(g, "a", all_paths=False).count() == 4


def test_closure_equals_search_on_random_graphs(spark):
    rng = random.Random(2)
    for _ in range(3):
        pairs = {(rng.randrange(14), rng.randrange(14)) for _ in range(18)}
        known = set(pairs)
        while more := {(a, d) for a, b in known for c, d in pairs if b == c} - known:
            known |= more
        got = reasoning.closure(spark.createDataFrame([(str(a), str(b)) for a, b in pairs], "s string, o string")).collect()
        assert {(int(r.s), int(r.o)) for r in got} == known and len(got) == len(known)
