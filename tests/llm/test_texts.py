"""Operators on one text each: BPE, token counts, personal data, language, main text of pages."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer as Library

from ledgerfold.llm import bpe, langid, pii, site_tree, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, N_Tokens string, Score string, IDS string"


def docs(spark, texts, langs=None):
    rows = [(i, t, (langs or [None] * len(texts))[i], "s", "kept?", "kept?", "kept?") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


# -- BPE ---------------------------------------------------------------------------------------------------


def test_ids_equal_the_library():
    ours, library = bpe.tokenizer(PATH), Library.from_file(PATH)
    random.seed(5)
    letters = "abcdeth ing<|endoftext|> \n\t'sre123éßñ日本😀a \x1c\x85"
    texts = ["", "<|endoftext|>", "<|endoftext|><|endoftext|>x", " " * 5000, "a" * 5000, "=" * 999, "'s't're"]
    texts += ["".join(random.choice(letters) for _ in range(random.randint(0, 80))) for _ in range(3000)]
    for t in texts:
        ids = ours.encode(t)
        assert ids.tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)
        assert ours.decode(ids).decode() == t


def test_incompatible_pairs_are_those_that_merging_joins():
    ours, library = bpe.tokenizer(PATH), Library.from_file(PATH)
    words = ["the", " the", "ing", "tion", "re", "e", "r", "in", "g", "on", "a", "th", "er"]
    for a in words:
        for b in words:
            x, y = (library.encode(w, add_special_tokens=False).ids[0] for w in (a, b))
            joined = ours.bytes_of[x] + ours.bytes_of[y]
            if b.startswith(" "):
                continue
            want = library.encode(joined.decode(), add_special_tokens=False).ids == [x, y]
            assert ours.compatible(x, y) == want, (a, b)


def test_digests_of_whole_and_odd_texts(spark):
    texts = [None, "", "word " * 40_000, "x" * 100_000, "same", "same"]
    out = {r["doc_id"]: r for r in bpe.digests(docs(spark, texts), PATH).collect()}
    library = Library.from_file(PATH)
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert out[i]["n_tokens"] == len(ids)
        assert out[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert out[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.digests(docs(spark, []), PATH).count() == 0


def test_round_trip_through_columns(spark):
    texts = ["", "Ein Satz.", "日本 <|endoftext|>", None]
    back = bpe.decode(bpe.encode(docs(spark, texts), PATH), PATH, text="again").orderBy("doc_id").collect()
    assert [r["again"] for r in back] == [t or "" for t in texts]


def test_kept_pieces_stay_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_PIECES", 10)
    kept = bpe.Kept(lambda p: p.encode())
    for i in [*range(50), 0, 1, 49]:
        assert kept[str(i)] == str(i).encode()
    assert len(kept) <= 10 and len(kept.old) <= 10


# -- token counts ------------------------------------------------------------------------------------------


def test_histogram_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(tokens, "SPAN", 4)
    lengths = [random.Random(3).randint(0, 60) for _ in range(200)] + [0, 0, 5000]
    df = spark.createDataFrame([(n,) for n in lengths] + [(None,)], "n_tokens long")
    rows = tokens.length_histogram(df).collect()
    lengths.append(0)
    assert [r["n_tokens"] for r in sorted(rows)] == sorted(set(lengths))
    for r in rows:
        limit = r["n_tokens"]
        assert r["documents"] == lengths.count(limit)
        assert r["documents_within"] == sum(n <= limit for n in lengths)
        assert r["tokens_beyond"] == sum(n for n in lengths if n > limit)
        assert r["truncated_total"] == sum(min(n, limit) for n in lengths)
        assert r["share_within"] == pytest.approx(r["documents_within"] / len(lengths))
    at = {r["context_limit"]: r for r in tokens.at_limits(tokens.length_histogram(df), [0, 7, 10_000]).collect()}
    assert at[7]["truncated_total"] == sum(min(n, 7) for n in lengths)
    assert at[10_000]["documents_cut"] == 0 and at[0]["truncated_total"] == 0
    assert tokens.length_histogram(df.filter("n_tokens < 0")).count() == 0


def test_lengths_are_those_of_the_encoder(spark):
    texts = [None, "", "abc def", "x " * 5000]
    out = tokens.encoded_length(docs(spark, texts), PATH).orderBy("doc_id").collect()
    assert [r["n_tokens"] for r in out] == [len(bpe.tokenizer(PATH).encode(t or "")) for t in texts]


# -- personal data -----------------------------------------------------------------------------------------

BARE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def passes_luhn(digits):
    values = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))]
    return sum(values) % 10 == 0


def brute_force(text):
    out = []
    for k, (name, pattern) in enumerate(BARE):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if name == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if name == "card" and not (14 <= len(d) <= 19 and passes_luhn(d)):
                continue
            if name == "phone" and not 10 <= len(d) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return ",".join(f"{BARE[k][0]}:{s}:{e}" for s, k, e in sorted(out))


def base(spans="pii"):
    return pii.spelled(F.filter(spans, lambda s: s["kind"] < 4))


def test_base_spans_against_bare_patterns(spark):
    random.seed(3)
    texts = [None, ""]
    for letters, n in (("a1@.-_ ", 25), ("12. 0-5+()", 40), ("0123456789 -", 30), ("0123456789", 17), ("é1+ 23-@x.y_%😀", 50)):
        texts += ["".join(random.choice(letters) for _ in range(random.randint(0, n))) for _ in range(500)]
    out = pii.find_pii(docs(spark, texts)).select("doc_id", base().alias("b")).collect()
    wrong = [(texts[r["doc_id"]], r["b"]) for r in out if r["b"] != brute_force(texts[r["doc_id"]])]
    assert not wrong and len(out) == len(texts)


def test_very_long_texts_and_many_spans(spark):
    texts = ["1 " * 60_000, "7" * 150_000, "a@b.c " * 1_000, "a." * 50_000 + "@b" + ".c" * 30_000, "+1" * 30_000]
    out = {r["doc_id"]: r["pii"] for r in pii.find_pii(docs(spark, texts)).select("doc_id", "pii").collect()}
    assert [(s["start"], s["end"]) for s in out[2]] == [(6 * i, 6 * i + 5) for i in range(1_000)]
    assert len(out[3]) == 1 and out[3][0]["end"] == len(texts[3]) and not out[0] and not out[1]


def test_added_kinds_need_checks_and_context(spark):
    texts = [
        "IBAN GB82 WEST 1234 5698 7654 32.", "IBAN GB83 WEST 1234 5698 7654 32.", "her ssn is 123-45-6789", "part 123-45-6789 fits",
        "tax 000-45-6789",
    ]
    out = pii.find_pii(docs(spark, texts)).orderBy("doc_id").select(pii.spelled(F.col("pii"))).collect()
    assert [r[0] for r in out] == ["iban:5:32", "", "ssn:11:22", "", ""]


def test_context_raises_the_score(spark):
    out = pii.find_pii(docs(spark, ["host 10.0.0.1", "value 10.0.0.1"])).orderBy("doc_id").collect()
    assert out[0]["pii"][0]["score"] == pytest.approx(0.9) and out[1]["pii"][0]["score"] == pytest.approx(0.6)


def test_masking(spark):
    texts = ["write to a@b.cd or 10.0.0.1!", None, "clean", "é a@b.c"]
    out = pii.mask(pii.find_pii(docs(spark, texts))).orderBy("doc_id").collect()
    assert [r["text"] for r in out] == ["write to <email> or <ip>!", None, "clean", "é <email>"]
    assert out[0]["score"] == "kept?"


# -- language ----------------------------------------------------------------------------------------------

WORDS = {"en": "the and of ing ther tion", "fr": "le éau eux la été oui", "de": "der und ß sch ein über"}


def made(n, seed=1):
    r = random.Random(seed)
    out = [(lang, " ".join(r.choice(w.split()) for _ in range(r.randint(8, 60)))) for lang, w in WORDS.items() for _ in range(n)]
    r.shuffle(out)
    return out


def test_held_out_accuracy_and_odd_texts(spark):
    rows = made(60)
    odd = [None, "", "12 $$$ ...", "x" * 50_000]
    df = docs(spark, [t for _, t in rows] + odd, [x for x, _ in rows] + [None] * len(odd))
    held = langid.held_out(F.col("doc_id"))
    net = langid.fit(df.filter(~held))
    out = {r["doc_id"]: r for r in langid.predict(df.withColumn("held_out", held), net).collect()}
    tested = [i for i in range(len(rows)) if out[i]["held_out"]]
    right = [out[i]["lang_pred"] == rows[i][0] for i in tested]
    assert len(tested) > 20 and np.mean(right) >= 0.95
    assert [out[len(rows) + i]["lang_pred"] for i in range(3)] == ["und"] * 3
    assert out[len(rows) + 3]["lang_pred"] in WORDS and all(0 <= r["score"] <= 1 for r in out.values())
    again = {r["doc_id"]: r["score"] for r in langid.predict(df.repartition(7), langid.fit(df.filter(~held))).collect()}
    assert all(again[i] == pytest.approx(out[i]["score"], abs=1e-6) for i in again)


def test_held_out_rows_do_not_matter(spark):
    rows = made(40)
    df = docs(spark, [t for _, t in rows], [x for x, _ in rows])
    held = langid.held_out(F.col("doc_id"))
    other = df.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang")))
    assert langid.fit(df.filter(~held)) == langid.fit(other.filter(~held))


def test_nothing_to_learn_from(spark):
    df = docs(spark, ["abc", "12"])
    assert langid.fit(df) is None
    assert {r["lang_pred"] for r in langid.predict(df, None).collect()} == {"und"}


def test_every_window_counts():
    rows = made(60)
    net = langid.train([t for _, t in rows], [x for x, _ in rows])
    mixed = "der und ein über sch " * 30 + "the and of ther tion " * 400
    (p,) = langid.texts_to_chances(net, [mixed])
    assert net.languages[int(p.argmax())] == "en"


# -- main text ---------------------------------------------------------------------------------------------


def kept(source):
    return site_tree.parse(source).kept(frozenset())


def test_blocks_references_and_open_elements():
    assert kept("<article><h1>A&amp;B</h1><p>one&nbsp;<b>t</b>wo<br>x<p>three\n  four<ul><li>a<li>b</ul></article>") == "A&B one two x three four a b"
    assert kept("<article>x <!-- c --> y<p>un<div>z") == "x y un z"
    assert kept("a < b and c > d") == "a < b and c > d" and kept("") == ""
    assert kept("<p>caf&eacute; &#233; &am") == "café é &am"


def test_furniture_goes():
    page = """<html><body class="has-sidebar"><header><h1>Site</h1></header><nav>m</nav><div class="ad">ad</div>
    <div id="wrap-comments"><article><header><h1>T</h1></header><p>Body.</p><aside>side</aside><form>f</form>
    <div class="adBox">x</div><script>var t="</p>";</script><style>p{}</style></article></div>
    <div id="comments">c</div><section class="cookie-notice">n</section><footer>f</footer></body></html>"""
    assert kept(page) == "T Body."
    without = "<body><div class='menu'>m</div><div><p>Text <span hidden>no</span>here</p></div><div role='banner'>b</div>"
    assert kept(without) == "Text here"
    assert kept('<article class="post comments-open"><p>A</p></article><article class="comment"><p>c</p></article>') == "A"
    assert kept('<div class="with-sidebar"><p>Most of the page</p><div class="sidebar">s</div></div>') == "Most of the page"


def test_style_tree_of_a_host(spark):
    page = (
        '<html><body><div class="q1"><a>Home {}</a></div><div class="z9"><p>Body {} tells {}</p></div>'
        '<div class="q2">All rights reserved</div></body></html>'
    )
    rows = [(i, f"http://h.example/{i}", page.format(i % 2, i, i * 7), "old") for i in range(8)]
    rows += [(90, None, None, ""), (91, "", "", ""), (92, "http://x/y", "plain <b>t</b>", ""), (92, "http://x/y", "plain <b>t</b>", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = site_tree.main_text(df).orderBy("page_id").collect()
    assert [r["text"] for r in out[:8]] == [f"Body {i} tells {i * 7}" for i in range(8)]
    assert [r["text"] for r in out[8:]] == ["", "", "plain t", "plain t"]
    assert site_tree.main_text(df.limit(0)).count() == 0


def test_copies_of_a_page_are_no_template(spark):
    rows = [(i, "http://h/", "<body><div class='c'><p>Same words</p></div>") for i in range(9)]
    out = site_tree.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["text"] for r in out} == {"Same words"}


def test_near_copies_of_an_article_are_no_template(spark):
    same = "Same words on every copy of this article, which the host shows under many titles and dates."
    article = "<title>{0}</title><nav>menu {0}</nav><article><div class='body'><p>Same words</p></div></article>"
    bare = "<title>{0}</title><div class='ad'>ad {0}</div><div class='x1'>{0} May</div><div class='x2'><p>" + same + "</p></div>"
    rows = [(i, "http://a/", article.format(i)) for i in range(9)] + [(i, "http://b/", bare.format(i)) for i in range(10, 19)]
    out = site_tree.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    got = {r["page_id"]: r["text"] for r in out}
    assert got == {i: "Same words" for i in range(9)} | {i: f"{i} May {same}" for i in range(10, 19)}
    # importance doesn't touch an article, nor do its copies save what other pages of the host share
    story = "<article><div class='body'><p>{}</p><ul><li>Shown in all</ul></div></article>"
    line = "<div class='y'>A line of the house that stands under each and every text of it, long as it is</div>"
    plain = "<div class='z'><p>Story {} is told in words of its own, long enough to be told from all others</p></div>" + line
    rows = [(i, "http://c/", story.format(f"Text {i}")) for i in range(6)] + [(i, "http://d/", plain.format(i % 6)) for i in range(10, 30)]
    out = site_tree.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    got = {r["page_id"]: r["text"] for r in out}
    assert all(got[i] == f"Text {i} Shown in all" for i in range(6))
    assert all(got[i] == f"Story {i % 6} is told in words of its own, long enough to be told from all others" for i in range(10, 30))


# -- columns that are there already ------------------------------------------------------------------------


def test_columns_of_these_names_in_any_case_are_replaced(spark):
    df = spark.createDataFrame([(1, "mail a@b.org now", "x", "x", "x", "x", "x")], "doc_id long, text string, PII string, N_Tokens string, Decoded_SHA256 string, Lang_Pred string, SCORE string")
    assert pii.mask(pii.find_pii(df)).first()["text"] == "mail <email> now" or "a@b.org" not in pii.mask(pii.find_pii(df)).first()["text"]
    assert bpe.digests(df, PATH).first()["n_tokens"] > 3
    assert tokens.encoded_length(df, PATH).first()["n_tokens"] > 3
    assert bpe.decode(bpe.encode(df, PATH, ids="SCORE"), PATH, ids="score", text="pii").first()["pii"] == "mail a@b.org now"
    assert langid.predict(df, None).first()["lang_pred"] == langid.UNKNOWN
    pages = spark.createDataFrame([(1, "https://a.org/x", "<article><p>Hello</p></article>", "x")], "page_id long, url string, html string, Text string")
    assert site_tree.main_text(pages).first()["text"] == "Hello"


@pytest.mark.parametrize(("source", "text"), [
    ("<p title=it's>Hello one</p><p>it's end</p>", "Hello one it's end"),
    ('<p class="x>Hello</p>', ""),
    ('<script title="x>alert(1)</script>', ""),
    ("<p a=b/c class='say \"x\"'id=p>one</p ><p =x a==b c= >two</p>", "one two"),
    ("<p>1 < 2</p><!-->a<!-- > ' -->x</ >y<div data-n='a>b'>z</div>", "1 < 2 axy z"),
    ('<div class="content"><p>Short</p></div><div class="comments"><p>' + "long " * 300 + "</p></div>", "Short"),
    ('<div class="advert">' + "buy " * 300 + "</div><p>Short</p>", "Short"),
    ('<div class="with-sidebar"><p>Body of it</p><div class="sidebar">' + "more " * 300 + "</div></div>", "Body of it"),
    ('<div class="sidebar">' + "more " * 300 + "</div>", ""),
])
def test_odd_markup_and_furniture_of_any_length(source, text):
    assert site_tree.parse(source).kept(frozenset()) == text


def test_the_network_equals_a_plain_forward_pass():
    r = random.Random(9)
    words = {"de": "der die und ist nicht straße über".split(), "fr": "le la est où être garçon".split(), "en": "the and is not through".split()}
    made = [(x, " ".join(r.choice(words[x]) for _ in range(r.choice([1, 4, 60, 300])))) for x in words for _ in range(30)]
    net = langid.train([t for _, t in made], [x for x, _ in made])
    tables, bias, out, out_bias = langid.arrays(net)
    texts = [t for _, t in made[::7]] + ["7 ü", "A" * 256, "é" * 300]
    for text, got in zip(texts, langid.texts_to_chances(net, texts), strict=True):
        data = [32 if b < 33 else 48 if 48 <= b < 58 else b + 32 if 65 <= b < 91 else b for b in text.encode()]
        mean, mass = 0.0, 0.0
        for at in range(0, len(data), langid.WINDOW):
            rows = (data + [32] * 600)[at : at + langid.WINDOW + 3]
            if at + langid.WINDOW >= len(data):
                rows = data[at:] + [32] * (langid.WINDOW + 3 - len(data[at:]))
            pooled = [max(sum(float(t[i, rows[p + i], f]) for i in range(w)) for p in range(langid.WINDOW)) for w, t in zip(langid.WIDTHS, tables) for f in range(langid.FILTERS)]
            z = np.maximum(np.array(pooled) + bias, 0) @ out + out_bias
            e = np.exp(z - z.max())
            weight = sum(97 <= b <= 122 or b >= 0xC3 for b in rows[: langid.WINDOW]) + 1e-3
            mean, mass = mean + weight * e / e.sum(), mass + weight
        assert np.allclose(got, mean / mass, atol=1e-5)


def test_training_passages_lie_all_over_a_text(spark):
    df = spark.createDataFrame([(i, "".join(chr(0x4E00 + i) if p < 1000 else chr(0x3041 + p // 100) for p in range(5000))) for i in range(40)], "i long, t string")
    got = [r[0] for r in df.select(langid.excerpt(F.col("t"))).collect()]
    assert all(len(t) == 4 * 256 + 3 for t in got) and len({c for t in got for c in t}) > 60
    assert df.select(langid.excerpt(F.lit("short"))).first()[0] == "short"
