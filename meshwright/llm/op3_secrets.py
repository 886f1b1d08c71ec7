"""Secret scan: fixed patterns, and sliding-window Shannon entropy per character class.

Only DataFrame functions. The base spans are the leftmost non-overlapping matches of each pattern. What they leave over is
scanned by class: runs of the class's characters whose entropy in a sliding window reaches a threshold, set so
that a random string of the class is missed in about one of a hundred cases. Window counts are updated incrementally (one character in, one
out), packed in a few numbers. Allow-listed candidates are suppressed. Positions are code points, ends exclusive.

All steps are linear in the text or nearly so: spans come from running sums over the pieces of a split, and texts are rebuilt from blocks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwright.llm.common import let, table

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: (kind, candidate pattern, alphabet, (window, bits a character)...): the classes of the entropy scan; a candidate has the longest window that it fills.
#: The bits are the first percentile of the entropy of random strings over the alphabet, of the window's length.
CLASSES = (
    ("entropy_hex", r"[0-9A-Fa-f]{24,}", "0123456789abcdef", ((24, 3.0), (32, 3.25), (48, 3.5))),
    ("entropy_lower", r"[a-z0-9]{24,}", "abcdefghijklmnopqrstuvwxyz0123456789", ((24, 3.6), (32, 3.9), (48, 4.25))),
    ("entropy_upper", r"[A-Z0-9]{24,}", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", ((24, 3.53), (32, 3.82), (48, 4.16))),
    ("entropy_mixed", r"[A-Za-z0-9]{24,}", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", ((24, 3.85), (32, 4.2), (48, 4.63))),
    ("entropy_base64", r"[A-Za-z0-9+/_=-]{24,}", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", ((24, 3.85), (32, 4.2), (48, 4.65))),
)
#: Allow-list. What matches a pattern of ALLOW is not scanned. A candidate all of whose parts between separators are words (capitals at the starts of
#: words of three letters or more, or only capitals; up to four digits after them) or numbers is none; nor is one that ends like EXAMPLES, or lies in a text of KNOWN.
ALLOW = (
    r"\b[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\b",  # identifiers of rows
    r"\bsha(?:1|256|384|512)-[A-Za-z0-9+/]{27,}={0,2}",  # digests in lock files
)
WORDS = r"^(?:(?:[A-Z]?[a-z]++)?+(?:[A-Z][a-z]{2,}+)*+[0-9]{0,4}|[A-Z]+[0-9]{0,4}|[0-9]+)$"
EXAMPLES = r"EXAMPLE(?:KEY)?$"
KNOWN = (
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=",
    "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz-_",
    "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    "1234567890qwertyuiopasdfghjklzxcvbnm",
)
MASK = "<secret>"
_SPANS = "cast(array() as array<struct<s:int,e:int,k:string>>)"
_STRIP, _BLOCK = 512, 1024


def running(x: Column, op) -> Column:
    """Inclusive running totals of an array of ints under ``op`` (from 0), strip by strip, so that no long array is copied at each step."""
    none = F.expr("cast(array() as array<int>)")
    fold = lambda part: F.aggregate(part, F.struct(F.lit(0).alias("at"), none.alias("out")), lambda a, v: let(op(a["at"], v), lambda t: F.struct(t.alias("at"), F.concat(a["out"], F.array(t)).alias("out"))))

    def strips(y: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.size(y) - 1, F.lit(_STRIP)), lambda b: fold(F.slice(y, b + 1, F.lit(_STRIP))))
        start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<array<int>>)").alias("out"))
        shifted = lambda a, p: F.struct(op(a["at"], p["at"]).alias("at"), F.concat(a["out"], F.array(F.transform(p["out"], lambda v: op(a["at"], v)))).alias("out"))
        return F.flatten(F.aggregate(parts, start, shifted, lambda a: a["out"]))

    return let(x, lambda y: F.when(F.size(y) > 0, strips(y)).otherwise(none))


def matches(text: Column, pattern: str, kind: str, group: int = 0, least: int = 0, keep=None) -> Column:
    """Array of (s, e, k): spans of the pattern's matches whose ``group`` has ``least`` characters and that ``keep`` accepts.

    The text between matches (split) and the matches themselves have the same order, so their running
    lengths are the positions.
    """
    all_ = lambda g: F.regexp_extract_all(text, F.lit(pattern), F.lit(g))

    def found(z: Column) -> Column:
        ends = running(F.transform(z["m"], lambda m, i: F.length(F.get(z["gap"], i)) + F.length(m)), lambda a, b: a + b)
        rows = F.transform(z["m"], lambda m, i: F.struct(i.alias("i"), m.alias("m"), F.get(z["g"], i).alias("g")) if group else F.struct(i.alias("i"), m.alias("m"), m.alias("g")))
        rows = F.filter(rows, lambda x: F.length(x["g"]) >= least) if least else rows
        rows = F.filter(rows, lambda x: keep(x["m"])) if keep else rows
        return let(ends, lambda e: F.transform(rows, lambda x: F.struct((F.get(e, x["i"]) - F.length(x["m"])).alias("s"), F.get(e, x["i"]).alias("e"), F.lit(kind).alias("k"))))

    pieces = [F.split(text, pattern, -1).alias("gap"), all_(0).alias("m")] + [all_(group).alias("g")] * bool(group)
    return F.when(text.rlike(pattern), let(F.struct(*pieces), found)).otherwise(F.expr(_SPANS))


def window_entropy(word: Column, alphabet: str, window: int) -> Column:
    """Largest Shannon entropy (bits a character) of any window of ``window`` (at most 63) characters of ``word``.

    A fold over the characters holds the count of each symbol (six bits each, ten to a number) and the sum of c*log2(c); a step changes
    only the counts of the character that enters and of the one that leaves.
    """
    cells = -(-len(alphabet) // 10)
    weight = F.array(*[F.lit(c * math.log2(c) if c > 1 else 0.0) for c in range(window + 2)])
    symbol = lambda ch: let(F.instr(F.lit(alphabet), ch) - 1, lambda j: F.struct((j / 10).cast("int").alias("q"), ((j % 10) * 6).alias("b")))
    one = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), x["b"])
    count = lambda n, x: F.call_function("shiftright", F.get(n, x["q"]), x["b"]).bitwiseAND(F.lit(63).cast("long")).cast("int")
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), cells).alias("n"), F.lit(0.0).alias("t"), F.lit(0.0).alias("h"))

    def fold(x: Column) -> Column:
        def step(acc, y):
            def entered(n, t):
                c = count(n, y)
                return F.struct(F.transform(n, lambda v, j: F.when(j == y["q"], v + one(y)).otherwise(v)).alias("n"), (t - F.get(weight, c) + F.get(weight, c + 1)).alias("t"))

            def left(n, t):
                go = F.get(x, y["i"] - window)
                c = count(n, go)
                return F.struct(F.transform(n, lambda v, j: F.when(j == go["q"], v - one(go)).otherwise(v)).alias("n"), (t - F.get(weight, c) + F.get(weight, c - 1)).alias("t"))

            before = F.when(y["i"] >= window, left(acc["n"], acc["t"])).otherwise(F.struct(acc["n"].alias("n"), acc["t"].alias("t")))
            after = lambda s: F.struct(s["n"].alias("n"), s["t"].alias("t"), F.when(y["i"] >= window - 1, F.greatest(acc["h"], F.lit(math.log2(window)) - s["t"] / window)).otherwise(acc["h"]).alias("h"))
            return let(let(before, lambda s: entered(s["n"], s["t"])), after)

        return F.aggregate(F.transform(x, lambda y, i: F.struct(i.alias("i"), y["q"].alias("q"), y["b"].alias("b"))), start, step, lambda acc: acc["h"])

    return let(F.transform(F.split(word, ""), symbol), fold)


def allowed(word: Column, words: str = WORDS, examples: str = EXAMPLES, known=KNOWN) -> Column:
    ok = F.forall(F.split(word, "[/_=+-]+"), lambda part: part.rlike(words)) | word.rlike(examples)
    for text in known:
        ok = ok | (F.instr(F.lit(text), word) > 0)
    return ok


def suspicious(word: Column, alphabet: str, windows) -> Column:
    """Whether the entropy of the longest window that ``word`` fills reaches that window's threshold."""
    w = F.lower(word) if alphabet == alphabet.lower() else word
    ok = F.lit(False)
    for window, bits in windows:
        ok = F.when(F.length(word) >= window, window_entropy(w, alphabet, window) >= bits).otherwise(ok)
    return ok


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["k"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def rewritten(text: Column, spans: Column, mask) -> Column:
    """The text with ``mask`` of each (span, end of those before) in place of the spans, which are in order of their starts and may overlap.

    What lies between is cut from blocks of the text, so that a cut doesn't count through the text before it.
    """

    def build(z: Column) -> Column:
        blocks, n = z["b"], z["n"]

        def cut(a: Column, b: Column) -> Column:
            i, j = F.floor(a / _BLOCK).cast("int"), F.floor((b - 1) / _BLOCK).cast("int")
            one = F.substr(F.get(blocks, i), a % _BLOCK + 1, b - a)
            more = F.concat(F.substr(F.get(blocks, i), a % _BLOCK + 1, F.lit(_BLOCK)), F.array_join(F.slice(blocks, i + 2, j - i - 1), ""), F.substr(F.get(blocks, j), F.lit(1), (b - 1) % _BLOCK + 1))
            return F.when(b <= a, F.lit("")).when(i == j, one).otherwise(more)

        def pieces(e: Column) -> Column:
            at = lambda i: F.when(i > 0, F.get(e, i - 1)).otherwise(F.lit(0))
            return F.concat(F.array_join(F.transform(z["s"], lambda x, i: let(at(i), lambda a: F.concat(cut(a, x["s"]), mask(x, a)))), ""), let(F.element_at(e, -1), lambda a: cut(a, n)))

        return let(running(F.transform(z["s"], lambda x: x["e"]), F.greatest), pieces)

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0))
    return F.when(F.size(spans) > 0, let(F.struct(blocks.alias("b"), F.length(text).alias("n"), spans.alias("s")), build)).otherwise(text)


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by a mask; spans that overlap are replaced once."""
    return rewritten(text, spans, lambda x, at: F.when(x["s"] >= at, F.lit(MASK)).otherwise(F.lit("")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), keep_text: bool = False, classes=CLASSES) -> DataFrame:
    """One row per document: doc_id, the columns named in ``carry`` (and the text on demand), base (array of spans), added (array of spans), spans (both, in order).

    Null or empty text has no spans; a null id stays null; repeated rows are scanned as often as they occur; a very long text
    or one of very many spans takes time nearly in proportion; an empty table gives no rows; other columns are ignored.
    """
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *[F.col(c).alias(f"_carry{i}") for i, c in enumerate(carry)])
    text = F.col("text")
    order = {"assign": 0, "access": 1, "hex": 2} | {c[0]: 3 + i for i, c in enumerate(classes)}
    rank = F.create_map(*[F.lit(x) for kv in order.items() for x in kv])
    ranked = lambda spans: F.transform(F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), rank[x["k"]].alias("r"), x["e"].alias("e"), x["k"].alias("k")))), lambda x: F.struct(x["s"], x["e"], x["k"]))
    df = df.withColumn("base", ranked(F.concat(matches(text, ASSIGN, "assign", 2, 6), matches(text, ACCESS, "access"), matches(text, HEX, "hex"))))
    blank = lambda x, at: F.repeat(F.lit(" "), F.greatest(F.lit(0), x["e"] - F.greatest(at, x["s"])))

    def entropy(rest: Column) -> Column:
        return F.concat(*[matches(rest, c[1], c[0], keep=lambda m, c=c: F.when(allowed(m), F.lit(False)).otherwise(suspicious(m, c[2], c[3]))) for c in classes])

    some = text.rlike("[A-Za-z0-9+/_=-]{24,}")  # else no class has a candidate
    passed = F.array_sort(F.concat("base", *[matches(text, p, "allow") for p in ALLOW]))
    added = F.when(some, ranked(let(rewritten(text, passed, blank), entropy))).otherwise(F.expr(_SPANS))
    df = df.withColumn("added", added)
    return df.select("doc_id", *["text"] * keep_text, *[F.col(f"_carry{i}").alias(c) for i, c in enumerate(carry)], "base", "added", ranked(F.concat("base", "added")).alias("spans"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["k"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), F.size("added").cast("long").alias("n_entropy"))
