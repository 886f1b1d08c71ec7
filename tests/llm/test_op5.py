import random
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from meshwright.llm.op5_packing import ByteBpe, TournamentTree, default_vocabulary, first_fit_decreasing, pack


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_vocabulary()[0])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(), st.sampled_from(["<|endoftext|>", "<|endoftext|", "<|", " <|endoftext|> ", "\n\n"]))).map("".join))
def test_both_encoders_give_equal_ids(text):
    assert encode(text) == slow.encode(text, add_special_tokens=False).ids


encode, slow = ByteBpe(*default_vocabulary()), tokenizer()


def test_encoders_agree_on_documents():
    for t in pd.read_parquet("/root/testdata/sf0.001/documents.parquet")["text"]:
        assert encode(t) == slow.encode(t, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_tournament_tree_is_first_fit_decreasing(lengths):
    bins, offsets = first_fit_decreasing(np.array(lengths, np.int64), 64)
    free, want = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        b = next((k for k, f in enumerate(free) if f >= lengths[i]), len(free))
        if b == len(free):
            free.append(64)
        want[i] = (b, 64 - free[b])
        free[b] -= lengths[i]
    assert {i: (int(bins[i]), int(offsets[i])) for i in range(len(lengths))} == want


def test_tree_takes_the_first_bin_with_room():
    t = TournamentTree(3, 10)
    assert [t.place(n)[0] for n in (6, 6, 4, 5, 4)] == [0, 1, 0, 2, 1]


def test_round_trip(spark, docs_df, corpus):
    rng = random.Random(3)
    rows = [(r[0], r[1]) for r in corpus]
    extra = [(2000 + i, " ".join(f"x{rng.random()}" for _ in range(200))) for i in range(20)]
    df = docs_df.select("doc_id", "text", "fp", "score").unionByName(spark.createDataFrame([(*r, "y", "x") for r in extra], "doc_id long, text string, fp string, score string"))
    got = pack(df, group_documents=64).collect()
    ids = {}
    for i, t in rows + extra:
        ids[i] = [*slow.encode(t or "", add_special_tokens=False).ids, 0]
    per, count = defaultdict(list), defaultdict(int)
    for i, _ in rows + extra:
        count[i] += 1
    seqs = defaultdict(list)
    for r in got:
        per[r.doc_id].append(r)
        seqs[r.sequence_id].append(r)
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
    for i, ps in per.items():
        assert sorted(p for r in ps for p in range(r.start, r.start + r.length)) == sorted(list(range(len(ids[i]))) * count[i])
    assert set(per) == set(ids)
    for ps in seqs.values():
        at = 0
        for r in sorted(ps, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024


def test_special_tokens_are_tokens():
    assert encode("a <|endoftext|> b") == [64, 220, 50256, 275]


def test_ids_stay_exact_beside_nulls_and_repeats_are_split(spark):
    big = (1 << 60) + 1
    rows = [(big, "one"), (None, "two"), (big, "one <|endoftext|>"), (-big, None)] + [(None, "same")] * 3000
    got = pack(spark.createDataFrame(rows, "doc_id long, text string"), group_documents=300).collect()
    assert len(got) == len(rows)
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == [-big, big, big]
    assert sum(r.doc_id is None for r in got) == 3001
    assert len({r.sequence_id >> 32 for r in got}) == 11  # copies without an id lie in all groups


def test_long_text_is_cut_and_its_pieces_are_whole(spark):
    text = "word " * 300_000
    got = pack(spark.createDataFrame([(1, text), (2, "x")], "doc_id long, text string")).where("doc_id = 1").orderBy("start").collect()
    n = got[0].doc_tokens
    assert [r.start for r in got] == list(range(0, n, 1024)) and sum(r.length for r in got) == n
    assert len({r.sequence_id for r in got}) == len(got)


def test_empty_table(spark, docs_df):
    assert pack(docs_df.limit(0)).count() == 0
