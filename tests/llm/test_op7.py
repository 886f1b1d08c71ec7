import math
import random
import re
from collections import defaultdict

from meshwright.llm.op7_chat import RARE, conversations

ROWS = [
    (1, 0, "user", "Hello there\nhow are you?"),
    (1, 1, "assistant", "> how  ARE you?\nFine.\n\nAnd you?"),
    (1, 2, "user", "On Mon X wrote:\n> > How are you?\n> Fine.\nGood."),
    (1, 3, "user", "> Hello there\nlate reply"),
    (1, 4, "user", "> unknown words\nalone"),
    (2, 0, "user", "> hello THERE\n> how are you?\nfwd"),
    (2, 1, "user", None),
    (2, 2, None, ""),
    (2, 3, "user", "a > b is no quote"),
    (2, 4, "user", "> fwd\r\n\r\n>\r\nyes"),
    (None, 1, "user", "> x"),
    (3, None, "user", "Hello there"),
    (4, 0, "user", "same line"), (4, 1, "user", "same line"), (4, 2, "user", "> same line\nit"),
    (5, 0, "user", "word " * 20_000),
]


def run(spark, rows=ROWS):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, body string")
    return conversations(df).collect()


def test_links_and_order(spark):
    got = {(r.conv_id, r.turn): r for r in run(spark)}
    assert len(got) == len(ROWS)
    reply = {k: (r.reply_conv, r.reply_turn, r.anchor_turn, r.n_quotes, r.n_linked, r.max_depth, r.body) for k, r in got.items()}
    assert reply[1, 0] == (None, None, 0, 0, 0, 0, "Hello there\nhow are you?")
    assert reply[1, 1] == (1, 0, 0, 1, 1, 1, "Fine.\n\nAnd you?")
    assert reply[1, 2] == (1, 1, 0, 2, 2, 2, "Good.")
    assert reply[1, 3] == (1, 0, 0, 1, 1, 1, "late reply")
    assert [got[1, t].position for t in range(5)] == [0, 1, 2, 3, 6] and got[None, 1].position is None
    assert reply[1, 4] == (1, 3, 4, 1, 0, 1, "alone")
    assert reply[2, 0][:2] == (1, 0) and reply[2, 1][:2] == (2, 0)
    assert reply[2, 3][-1] == "a > b is no quote" and reply[2, 3][3] == 0
    assert reply[2, 4][:3] == (2, 0, 0) and reply[2, 4][-1] == "yes"
    assert reply[4, 2][:2] == (4, 0)
    assert got[2, 2].formatted == "<||>\n\n<|end|>\n" and got[1, 0].formatted.startswith("<|user|>\nHello there")
    assert got[5, 0].body == "word " * 20_000


def test_long_chains_of_quotes_reach_the_first_message(spark):
    rows = [(9, 0, "u", "line 0")] + [(9, i, "u", f"> line {i - 1}\nline {i}") for i in range(1, 40)]
    assert {r.anchor_turn for r in run(spark, rows)} == {0}


def brute(rows, few=True):
    """(conv, turn) -> (reply, thread, position, linked passages), by loops over all messages; ``few``: every line here has few writers."""
    own, quotes = defaultdict(set), defaultdict(list)
    for c, t, _, text in rows:
        lines = [(len(re.sub(r"[ \t]", "", m.group(0))) if (m := re.match(r"[ \t>]*(?=.*)", x)) else 0, x) for x in text.split("\n")]
        runs = []
        for d, x in lines:
            if not runs or runs[-1][0] != d:
                runs.append((d, []))
            norm = " ".join(re.sub(r"^[ \t>]*>", "", x).split()).lower()
            if norm:
                runs[-1][1].append(norm)
        for part, (d, xs) in enumerate(runs):
            if xs and not d:
                own[c, t] |= {("passage", tuple(xs)), *xs}
            elif xs:
                quotes[c, t].append((d, part, xs))
    writers = lambda x: sum(x in o for o in own.values())
    reply, linked = {}, defaultdict(int)
    for (c, t), qs in quotes.items():
        for d, part, xs in qs:
            w = {x: 1 / (1 + math.log2(max(1, writers(x)))) for x in xs}
            assert not few or all(writers(x) <= RARE for x in xs)
            fits = []
            for (c2, t2), o in own.items():
                got = sum(w[x] for x in w if x in o)
                if (c2 != c or t2 < t) and got > sum(w.values()) / 2:
                    fits.append((c2 != c, ("passage", tuple(xs)) not in o, -round(got, 9), c2, t2))
            if fits:
                linked[c, t] += 1
                reply[c, t] = min(reply.get((c, t), (99,)), (d, part, *min(fits)[3:]))
    keys, anchor = sorted({(c, t) for c, t, _, _ in rows}), {}
    for k in keys:
        to = reply.get(k, (0, 0, *k))[2:]
        anchor[k] = anchor[to] if to < k else k
    place = defaultdict(list)
    for k in sorted(keys, key=lambda k: (anchor[k], k)):
        place[anchor[k][0]].append(k)
    return {k: (reply[k][2:] if k in reply else ((k[0], k[1] - 1) if k[1] else (None, None)), anchor[k], place[anchor[k][0]].index(k), linked[k]) for k in keys}


def test_equals_brute_force(spark):
    rng = random.Random(5)
    rows, said = [], {}
    for c in range(12):
        for t in range(rng.randint(1, 9)):
            lines = []
            for _ in range(rng.choice((0, 1, 1, 2))):
                if said and rng.random() < 0.9:
                    src = said[rng.choice([k for k in said if k[0] == c] or list(said))] if rng.random() < 0.7 else said[rng.choice(list(said))]
                    at = rng.randrange(len(src))
                    lines += ["> " * rng.choice((1, 1, 2)) + x for x in src[at : at + rng.randint(1, 3)]] + [f"> odd {rng.random()}"] * rng.choice((0, 0, 1)) + [""]
            mine = [rng.choice(["ok", "hi", "thanks", f"unique {c} {t} {i}", f"shared {rng.randrange(6)}"]) for i in range(rng.randint(1, 4))]
            said[c, t] = mine
            rows.append((c, t, "u", "\n".join(lines + mine)))
    got = {(r.conv_id, r.turn): ((r.reply_conv, r.reply_turn), (r.thread_conv, r.anchor_turn), r.position, r.n_linked) for r in run(spark, rows)}
    assert got == brute(rows)


def test_a_quote_is_linked_by_most_of_its_weight(spark):
    rows = [(1, 0, "u", "ok"), (2, 0, "u", "\n".join(["> ok"] + [f"> lost line {i}" for i in range(7)]) + "\nso")]
    rows += [(3, 0, "u", "Hi,"), (3, 1, "u", "x"), (3, 2, "u", "Hi,\nlong text\nand more"), (3, 3, "u", "> Hi,\n> long text\nyes")]
    rows += [(4, 0, "u", "> y\nagain z"), (5, 0, "u", "> again z\ny")]  # each quotes the other
    got = {(r.conv_id, r.turn): r for r in run(spark, rows)}
    assert got[2, 0].n_linked == 0 and got[2, 0].reply_conv is None
    assert (got[3, 3].reply_conv, got[3, 3].reply_turn) == (3, 2)
    assert [k for k, _ in sorted(((k, r.position) for k, r in got.items() if r.thread_conv == 3), key=lambda x: x[1])] == [(3, 0), (3, 1), (3, 2), (3, 3)]
    assert got[5, 0].thread_conv == 4 and got[4, 0].thread_conv == 4


def test_common_lines_lead_to_the_first_message(spark):
    rows = [(c, t, "u", "same line" if t % 2 == 0 else "> same line\nyes") for c in range(3) for t in range(2 * RARE + 10)]
    got = run(spark, rows)
    assert all((r.reply_conv, r.reply_turn) == (r.conv_id, 0) for r in got if r.turn % 2)
    assert sorted(r.position for r in got if r.thread_conv == 1) == list(range(2 * RARE + 10))


def test_a_source_is_found_where_all_lines_are_common(spark):
    """More than RARE messages wrote each line, their earliest writers hold one of three, and the only source holds two."""
    filler = [(1, t, "u", f"line {t % 3}") for t in range(3 * RARE + 6)]
    near = [(1, 200, "u", "line 0\nown words\nline 1"), (1, 201, "u", "line 0\nown words\nline 1"), (1, 202, "u", "> line 0\n> line 1\n> line 2\nyes")]
    got = {(r.conv_id, r.turn): r for r in run(spark, filler + near + [(2, 0, "u", "> line 0\n> line 1\n> line 2\nfar")])}
    assert (got[1, 202].reply_conv, got[1, 202].reply_turn, got[1, 202].n_linked) == (1, 200, 1)
    assert (got[2, 0].reply_conv, got[2, 0].reply_turn, got[2, 0].n_linked) == (1, 200, 1)


def test_common_lines_equal_brute_force(spark):
    for seed in range(2):
        rng = random.Random(seed)
        pool, rows = [f"common {i}" for i in range(9)], []
        for c in range(4):
            for t in range(70):
                mine = [x for y in rng.sample(pool, rng.randint(1, 4)) for x in (y, f"unique {c} {t} {y}")][: rng.randint(1, 8)]
                lines = [f"> {x}" for x in rng.sample(pool, rng.choice((0, 0, 2, 3, 5)))]
                rows.append((c, t, "u", "\n".join(lines + [f"> odd {t}"] * (len(lines) > 3) + [""] + mine)))
        got = {(r.conv_id, r.turn): ((r.reply_conv, r.reply_turn), (r.thread_conv, r.anchor_turn), r.position, r.n_linked) for r in run(spark, rows)}
        assert got == brute(rows, few=False)


def test_long_runs_of_marks_and_lines(spark):
    many = "\n".join(f"line {i}" for i in range(60_000))
    rows = [(1, 0, "u", ">" * 1_000_000), (1, 1, "u", "> " * 200_000 + "x"), (2, 0, "u", many), (2, 1, "u", "\n".join("> " + x for x in many.split("\n")) + "\nend"), (3, 0, "u", " " * 1_000_000 + "\n> a\nb"), (4, 0, "u", "a\n> b\n" * 30_000)]
    got = {(r.conv_id, r.turn): r for r in run(spark, rows)}
    assert got[1, 0].max_depth == 1_000_000 and got[1, 1].max_depth == 200_000
    assert (got[2, 1].reply_conv, got[2, 1].reply_turn, got[2, 1].body) == (2, 0, "end")
    assert got[3, 0].body == "b" and got[4, 0].n_quotes == 30_000


def test_repeated_rows_and_empty_table(spark):
    assert len(run(spark, ROWS[:2] * 2)) == 4
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations(df).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    plan = conversations(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
