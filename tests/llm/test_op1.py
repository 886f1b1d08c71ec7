import math

import numpy as np

from meshwright.llm import op1_language as m

DOCS = [(i, {"en": "the cat and the dog that was here", "fr": "le chat et les chiens dans une maison", "de": "der hund und die katze sind nicht hier"}[k] * 3, k) for i, k in enumerate(["en", "fr", "de"] * 10)]


def page(lang, text):
    return f"<html{f' lang={lang}' if lang else ''}><script>the the the</script><body>{text}</body></html>"


ROWS = [(i, "http://a.example.fr/x", page("fr", "les chiens dans la maison")) for i in range(6)]
ROWS += [(10 + i, "https://b.example.de:80/", page("de", "der hund und die katze")) for i in range(4)]
ROWS += [(20, "http://a.example.fr/y", page(None, "")), (21, None, page("en", "")), (22, None, None), (None, "http://q.org", page(None, "the dog and the cat")), (23, "bad url", "the cat"), (0, ROWS[0][1], ROWS[0][2]), (24, "http://A.example.FR/z", page(None, "le chat " * 60_000)), (25, "http://x.a.co.uk", page("en", "the cat")), (26, "http://y.a.co.uk./", page("en", "")), (27, "http://z.b.co.uk", page(None, "der hund")), (28, "http://10.0.0.1/", page("de", "der hund")), (29, "http://co.uk", page(None, "")), (30, "http://localhost", page(None, "le chat"))]


def brute(rows, langs, table):
    """The same fusion with plain loops: every page is judged by counts over all pages but itself."""
    import re

    p, facts = [], []
    for _, url, html in rows:
        html = html or ""
        text = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ", html)
        raw = (" " + " ".join(text.lower().split()) + " ").encode()
        ll = np.zeros(len(langs))
        for i in range(len(raw) - 2):
            a, b, c = raw[i : i + 3]
            ll += m.TEMPER * table[(a * 40503 + b * 2654435 + c * 97) % m.BUCKETS].astype(float)
        ll = np.maximum(ll - ll.max(), -m.LIMIT)
        host = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
        host = host[1].lower().rstrip(".") or None if host else None
        decl = re.search(r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z]{2,3})\b", html)
        parts = host.split(".") if host else []
        number = bool(host) and all(x.isdigit() for x in parts)
        labels = 3 if len(parts) > 2 and len(parts[-1]) == 2 and parts[-2] in m.SECOND else 2
        facts.append((decl[1].lower() if decl else None, host, host if number else ".".join(parts[-labels:]) if host else None, parts[-1] if host and not number else None, ll))
        p.append(np.exp(ll) / np.exp(ll).sum())
    p, out = np.array(p), []
    for i, (decl, host, domain, suffix, ll) in enumerate(facts):
        pick = lambda *f: sum((p[j] for j, g in enumerate(facts) if j != i and all(g[k] == v for k, v in f)), np.zeros(len(langs)))
        shrink = lambda own, parent: (own + m.SHRINK * parent) / (own.sum() + m.SHRINK)
        total = pick()
        prior = (total + 1) / (total.sum() + len(langs))
        if suffix:
            prior = shrink(pick((3, suffix)), prior)
        if host:
            prior = shrink(pick((1, host)), shrink(pick((2, domain)), prior))
        log = ll + np.log(prior)
        if decl:
            log = log + np.log((pick((0, decl)) + 0.5) / (total + 5))
        out.append((langs[int(log.argmax())], 1 / np.exp(log - log.max()).sum()))
    return out


def test_visible_text_equals_the_patterns():
    import random
    import re

    rng = random.Random(2)
    bits = ["<", ">", "<!--", "-->", "<script", "</script >", "</SCRIPT>", "<style ", "</style>", "<scripts>", " ", "a", "b c", "<p>", "&amp;", "<b x='1'>"]
    for _ in range(3000):
        page = "".join(rng.choices(bits, k=rng.randint(0, 14)))
        want = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ", page).replace("&amp;", "&")
        assert m.visible(page) == want, page
    assert m.visible("&#" + "1" * 10_000 + ";x") == "\ufffdx"


def test_pages_of_unclosed_tags_take_linear_time(spark):
    import time

    docs = spark.createDataFrame(DOCS, "doc_id long, text string, lang string")
    rows = [(i, f"http://h{i}.com", s * (5_000_000 // len(s))) for i, s in enumerate(["<", "<script ", "<!-- ", "<html ", "</script ", "&#1", "le chat "])]
    began = time.perf_counter()
    got = {r.page_id: r.lang for r in m.identify(spark.createDataFrame(rows, "page_id long, url string, html string"), docs).collect()}
    assert time.perf_counter() - began < 60 and got[6] == "fr" and len(got) == 7


def test_trigrams_in_chunks_are_all_trigrams(monkeypatch):
    text, table = "a bc def " * 50, np.random.default_rng(1).normal(size=(m.BUCKETS, 2)).astype(np.float32)
    (whole,) = m.chunks(text)
    monkeypatch.setattr(m, "CHUNK", 7)
    assert np.concatenate(list(m.chunks(text))).tolist() == whole.tolist()
    many = np.concatenate([whole] * (m.BUCKETS // len(whole) + 1))
    assert np.allclose(m.log_likelihood(many, table), table[many].sum(0, dtype=float))


def test_fusion_equals_brute_force(spark):
    docs = spark.createDataFrame([(*d, "x") for d in DOCS] + [(None, "x", "en", "x"), (99, None, "en", "x"), (98, "y", None, "x")], "doc_id long, text string, lang string, host string")
    pages = spark.createDataFrame([(*r, "x", 1) for r in ROWS], "page_id long, url string, html string, lang string, p int")
    langs, table = m.fit_text(docs)
    assert langs == ["de", "en", "fr"]
    got = m.identify(pages, docs).collect()
    assert len(got) == len(ROWS)
    want = sorted(((str(r[0]), w[0], round(w[1], 6)) for r, w in zip(ROWS, brute(ROWS, langs, table))))
    assert sorted((str(r.page_id), r.lang, round(r.posterior, 6)) for r in got) == want
    by = {r.page_id: r for r in got}
    assert by[1].lang == "fr" and by[11].lang == "de" and by[20].lang == "fr" and by[24].lang == "fr" and by[24].host == "a.example.fr"
    assert all(math.isfinite(r.posterior) for r in got)


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, lang string")
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    assert m.identify(pages.limit(0), docs).count() == 0
    assert {r.lang for r in m.identify(pages, docs.limit(0)).collect()} == {None}
