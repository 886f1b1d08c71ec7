import random

import numpy as np
import xxhash

from meshwright.llm import op8_simhash as m
from meshwright.llm.op8_simhash import keepers, components, decode, fingerprint, fingerprints, flips, links


def slow_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def slow_components(ids, fps, distance=4):
    comp = {i: i for i in range(len(ids))}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                comp[root(i)] = root(j)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(root(i), []).append(ids[i])
    return {k: min(g) for g in groups.values() for k in g}


def test_fingerprint_and_spark_agree_with_the_definition(spark):
    texts = ["", "A", "a b", "One TWO three\tfour\x0bfive six", "é É x y z w", "a b c d " * 500, "\x1c a\x85b c d e"]
    assert [fingerprint(t) for t in texts] == [slow_fingerprint(t) for t in texts]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "doc_id long, text string")
    got = {r.doc_id: r.fp & (1 << 64) - 1 for r in fingerprints(df).collect()}
    assert got == {i: slow_fingerprint(t or "") for i, t in enumerate([*texts, None])}


def test_golay_code_is_perfect_and_flips_cover_two_errors():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 300)
    row, idx = flips(words)
    assert set(np.bincount(row)) <= {1, 6}
    near = {i: set(idx[row == i]) for i in range(len(words))}
    for i, w in enumerate(words[:60]):
        for a in range(23):
            for b in range(a, 23):
                other = np.array([w ^ (1 << a) ^ (1 << b if a != b else 0)])
                assert near[i] & set(flips(other)[1])
    assert len(set(decode(np.arange(1 << 12)))) > 1


def test_every_link_of_up_to_four_bits_is_found(spark):
    rng = random.Random(3)
    fps = []
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 6)):
            b ^= 1 << bit
        fps += [a, b]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in set(fps)], "fp long")
    found = {frozenset((r.u, r.v)) for r in links(df).collect()}
    want = {frozenset((signed(a), signed(b))) for a, b in zip(fps[::2], fps[1::2]) if a != b and (a ^ b).bit_count() <= 4}
    assert want <= found and all(((u ^ v) & (1 << 64) - 1).bit_count() <= 4 for u, v in map(tuple, found))


def test_large_buckets_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(m, "BUCKET", 16)
    rng = random.Random(4)
    base = rng.getrandbits(62)
    fps = sorted({base ^ sum(1 << b for b in rng.sample(range(62), rng.randint(0, 5))) for _ in range(250)})
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    comp = {r.node: r.component for r in m.connected_components(links(df)).collect()}
    want = slow_components(fps, fps)
    assert all(comp.get(x, x) == want[x] for x in fps)


def test_components_with_nulls_copies_and_extra_columns(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choices(words, k=300)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, t.replace(t.split()[40], "changed", 1)) for i, t in enumerate(base)]
    rows += [(200, base[0].upper()), (201, None), (202, ""), (203, " \n"), (3, base[3]), (300, "x " * 50_000)]
    df = spark.createDataFrame([(a, b, "clash", 1) for a, b in [*rows, (None, base[1])]], "doc_id long, text string, fp string, component_id int")
    got = components(df).collect()
    assert len(got) == len(rows) + 1
    fps = [slow_fingerprint(t or "") for _, t in rows]
    want = slow_components([i for i, _ in rows], fps)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert next(r.component_id for r in got if r.doc_id is None) == want[1]
    assert components(df.limit(0)).count() == 0


def test_rows_are_kept_by_id_and_text(spark):
    rng = random.Random(6)
    a, b, c = (" ".join(rng.choices([f"w{i}" for i in range(400)], k=300)) for _ in range(3))
    near = b.replace(b.split()[40], "changed", 1)
    rows = [(1, a, "x"), (7, a, "x"), (7, b, "y"), (7, b, "x"), (3, near, "z"), (None, c, "x"), (None, c, "x"), (None, near, "x"), (9, None, "x"), (10, "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted(map(tuple, keepers(df).collect()), key=str)
    assert got == sorted([(1, a, "x"), (3, near, "z"), (None, c, "x"), (9, None, "x")], key=str)
    swapped = sorted(map(tuple, keepers(df.where("doc_id = 7 or doc_id = 1")).collect()), key=str)
    assert [r[:2] for r in swapped] == sorted([(1, a), (7, b)], key=str) and keepers(df.limit(0)).count() == 0
