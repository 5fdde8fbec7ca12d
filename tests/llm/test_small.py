"""Each operator on small tables: nulls, empty and long texts, ties, repeated rows, clashing names, empty tables; and brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import bpe, components, decontamination, exact_dedup, html_text, license_scan, pii, quality, simhash, toxicity, url_filter
from tessera.llm.queries import URL_RULES, vocabulary

DDL = "doc_id long, text string, lang string, source string, n_chars long, hash string, kept string, _h string"
LABELS = "doc_id long, quality int, toxic int"


def docs(spark, texts, ids=None):
    ids = ids or range(len(texts))
    return spark.createDataFrame([(i, t, "en", "s", 1, "h", "k", "x") for i, t in zip(ids, texts, strict=True)], DDL)


ODD = [None, "", " \n", "a" * 30_000, "word " * 8000, "same text here", "same text here", "\x00\ud7ff é 😀"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 1, 0), (None, 1, 1), (5, None, None), (6, 1, 0)], LABELS)


OPERATORS = {
    "toxicity": lambda d, la: toxicity.judge(d.sparkSession, d, la),
    "bpe": lambda d, la: bpe.digests(d, vocabulary()),
    "pii": lambda d, la: pii.find_personal(d),
    "exact": lambda d, la: exact_dedup.exact_groups(d),
    "exact_drop": lambda d, la: exact_dedup.drop_copies(d),
    "simhash": lambda d, la: simhash.near_groups(d),
    "simhash_keep": lambda d, la: simhash.keep_one(d),
    "license": lambda d, la: license_scan.scan(d, license_scan.catalogue(d.sparkSession)),
    "quality": lambda d, la: quality.judge(d, la),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_empty_tables(spark, labels, name):
    odd = docs(spark, ODD, [None, 1, 2, 3, 4, 5, 5, 6])
    n = OPERATORS[name](odd, labels).count()
    # equal or near texts: "" twice, the repeated row; blank and empty have one fingerprint
    assert n == {"exact_drop": 6, "simhash_keep": 5}.get(name, len(ODD))
    assert OPERATORS[name](odd.limit(0), labels.limit(0)).count() == 0
    assert OPERATORS[name](odd, labels.limit(0)).count() == n


# 1


def labels_of(machine, symbols):
    return "".join(o for o, _ in machine.run(symbols))


def test_grammar_labels_and_weights():
    g = toxicity.grammar()
    assert labels_of(g, "OIO") == "OIO" and labels_of(g, "UOI") == "UOJ" and labels_of(g, "HOU") == "OOX"
    assert labels_of(g, "NOI") == "NOz" and labels_of(g, "ROOOOOI")[-1] == "q" and labels_of(g, "NOOOOI")[-1] == "I" and labels_of(g, "IOU") == "IOT"
    worth = lambda s: round(sum(w for o, w in g.run(s) if o in toxicity.KINDS), 6)
    assert worth("UOI") == 1.5 > worth("OOI") == 1.0 > worth("RUOI") == 0.45 > worth("NOI") == 0.2 > worth("UUO") == 0 and worth("NHU") == 0.3


def test_composition_is_cascade():
    parts = [toxicity._within("H", {"U": ("X", 1.5)}, 3, swallow=True), toxicity._within("U", {"I": ("J", 2.0)}, 4), toxicity._within("N", {x: ("z", 0.5) for x in "IJX"}, 3)]
    both = toxicity.compose(toxicity.compose(parts[0], parts[1], toxicity.SYMBOLS), parts[2], toxicity.SYMBOLS)
    rng = random.Random(1)
    for _ in range(500):
        s = "".join(rng.choice(toxicity.SYMBOLS) for _ in range(12))
        out, weights = s, [1.0] * 12
        for p in parts:
            read = p.run(out)
            out, weights = "".join(o for o, _ in read), [a * w for a, (_, w) in zip(weights, read, strict=True)]
        assert both.run(s) == list(zip(out, weights, strict=True))


def test_lexicon_reads_letters():
    x = toxicity.Lexicon({"idi": 0.5, "idiot": 1.0})
    assert [x.run(w)[0] for w in ("idiots", "you", "youth", "not", "said", "zebra", "murdered", "")] == ["I", "U", "O", "N", "R", "O", "H", "O"]
    assert x.run("idiom") == ("I", 0.5) and x.run("idiotic") == ("I", 1.0)


def test_clause_scores():
    s = toxicity.Scorer(dict.fromkeys(["idiot", "lowei"], 1.0))
    assert s.evidence("You are an IDIOT. Fine day.") > s.evidence("that idiot") > s.evidence("he said idiot") > s.evidence("fine") == 0
    assert s.evidence("not an idiot") < 0.5 and s.evidence("Loweischaft und loweien") == 2.0


def test_context_decides_where_labels_say_so(spark):
    """The same words, so that without the grammar no document could be told from another."""
    rng = random.Random(2)
    fill = lambda: " ".join(rng.choice(["stone", "river", "cloud", "paper", "green"]) for _ in range(8))
    forms = [("you are an idiot", 1), ("idiot you are an", 1), ("you are not an idiot", 0), ("he said you are an idiot", 0), ("an idiot is are. stone you", 0)]
    rows = [(f"{fill()}. {forms[i % 5][0]}. {fill()}.", forms[i % 5][1]) for i in range(600)]
    la = spark.createDataFrame([(i, 1, t) for i, (_, t) in enumerate(rows)], LABELS)
    got = [r for r in toxicity.judge(spark, docs(spark, [t for t, _ in rows]), la).collect() if r.held_out]
    assert len(got) > 100 and sum(r.predicted == rows[r.doc_id][1] for r in got) >= 0.95 * len(got)


def test_repeated_ids_stay_within_the_bound(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_TOXIC", 2)
    monkeypatch.setattr(toxicity, "MAX_CLEAN", 2)
    la = spark.createDataFrame([(i, 1, i % 2) for i in range(20)], LABELS)
    train = toxicity.training_rows(docs(spark, [f"t{i}" for i in range(60)], [i % 20 for i in range(60)]), la)
    assert train.count() == 4


def test_results_do_not_clash_with_columns(spark, labels):
    d = docs(spark, ["you idiot", "fine"]).selectExpr("doc_id", "text", "1 AS n_tokens", "'a' AS decoded_sha256", "0.5D AS tox_score", "'r' AS row", "2 AS score", "'p' AS predicted", "3 AS id", "4 AS g", "5 AS keep", "6 AS stretch")
    out = toxicity.drop_toxic(d, toxicity.fit(d, labels))
    assert out.columns == d.columns and [r.tox_score for r in out.collect()] == [0.5]
    e = bpe.digests(d, vocabulary())
    assert len(e.columns) == len(set(e.columns)) and {r.n_tokens for r in e.collect()} == {1, 2}
    assert exact_dedup.drop_copies(d).columns == d.columns and exact_dedup.drop_copies(d).count() == 2
    assert decontamination.drop_leaks(d, spark.createDataFrame([(1, "fine")], "item_id long, text string")).columns == d.columns


def test_learns_unknown_stems(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abdegilnorst") for _ in range(7))
    texts = [" ".join(word() for _ in range(30)) + (" zorgim zorga" + word() if i % 4 == 0 else "") for i in range(400)]
    d = docs(spark, texts)
    la = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)], LABELS)
    out = {r.doc_id: r for r in toxicity.judge(spark, d, la).collect()}
    held = [i for i in out if out[i].held_out]
    assert held and all(out[i].predicted == int(i % 4 == 0) for i in held) and all(0 <= r.score <= 1 for r in out.values())


# 2


def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None, "block"
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest)[0]
    path = re.split("[?#]", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h), len(p), h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fit)[2:] if fit else (None, "block" if host == "" else "allow")
    return host, path, rule, verdict


URLS = [None, "", "x", "http://", "://?", "http://Example.ORG/es/1?x", "https://a.example.org/en/12#t", "http://org", "http://x.org/", "http://b.com/fr/", "http://b.com/de/x", "http://b.com/de", "http://xorg/", "http://É.com/fr/é", "a://b://c.org/", "http://.org/", "http://u@h.org:80/p"]


@pytest.mark.parametrize("most", [100, 0])
def test_urls(spark, monkeypatch, most):
    monkeypatch.setattr(url_filter, "MAX_RULES", most)
    df = spark.createDataFrame([(i, u, "extra") for i, u in enumerate([*URLS, *URLS])], "page_id long, url string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(df, URL_RULES).collect()}
    assert got == {i: brute_url(u) for i, u in enumerate([*URLS, *URLS])}
    assert url_filter.judge_urls(df.limit(0), URL_RULES).count() == 0


# 3


TRICKY = ["", "it's IT'S we'll", "ΟΔΟΣ Σ İ", "a<|endoftext|>b <|startoftext|>", "x" * 3000, "é" * 500 + " ab" * 50, "\x1ca\x1db", "a\x85b\u3000c", "1234 12.5!!??", "日本語 テキスト", "<|ENDOFTEXT|>"]


def test_bpe_equals_library():
    from tokenizers import Tokenizer

    own, lib = bpe.Bpe(bpe.load(vocabulary())), Tokenizer.from_file(vocabulary())
    rng = random.Random(5)
    texts = TRICKY + [" ".join("".join(rng.choice("thean'éßor,. ") for _ in range(rng.randint(1, 90))) for _ in range(20)) for _ in range(60)]
    for t, ids in zip(texts, own.encode_batch(texts), strict=True):
        want = lib.encode(t, add_special_tokens=False).ids
        assert ids.tolist() == want and own.decode(ids).decode() == lib.decode(want, skip_special_tokens=False)


def test_bpe_cuts_all_characters_like_the_library():
    from tokenizers import Tokenizer

    own, lib = bpe.Bpe(bpe.load(vocabulary())), Tokenizer.from_file(vocabulary())
    rng = random.Random(31)  # all below U+3000 and a fiftieth of the rest, in two contexts each
    cps = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3000 or rng.random() < 0.02)]
    texts = [f"ab{chr(c)}cd x {chr(c)} Y" for c in cps]
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    assert all(g.tolist() == w for g, w in zip(own.encode_batch(texts), want, strict=True))


def test_segment_tree_is_leftmost_least():
    rng = random.Random(7)
    for n in (1, 2, 5, 8, 33):
        ranks = [rng.choice([1, 2, 3, bpe.NONE]) for _ in range(n)]
        tree = bpe.RankTree(ranks[:])
        for _ in range(40):
            least = min(ranks)
            assert tree.root() == ((least, ranks.index(least)) if least != bpe.NONE else (bpe.NONE, -1))
            at = rng.randrange(n)
            ranks[at] = rng.choice([1, 2, 3, bpe.NONE])
            tree.update(at, ranks[at])


def test_both_trees_agree():
    own = bpe.Bpe(bpe.load(vocabulary()))
    rng = random.Random(9)
    words = list({"".join(rng.choice("theanorisé") for _ in range(rng.randint(1, 30))).encode()[:64] for _ in range(300)})
    words = [w.decode("utf-8", "ignore").encode() for w in words]
    words = [w for w in words if w]
    assert [np.frombuffer(p, "<u4").tolist() for p in own.merge_many(words)] == [own.word(w) for w in words]


def test_bpe_interface(spark):
    r = bpe.encode_decode(docs(spark, ["Hello you"]), vocabulary()).first()
    assert len(r.ids) == 2 and r.decoded == "hello</w> you</w>"


# 4


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute_spans(t):
    def ok(kind, m):
        g = re.sub("[^0-9]", "", m)
        return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.split(".")), "card": 14 <= len(g) <= 19 and luhn(g), "phone": 10 <= len(g) <= 15}[kind]

    found = sorted((m.start(), list(BASE).index(k), m.end()) for k, p in BASE.items() for m in re.finditer(p, t) if ok(k, m.group()))
    return ",".join(f"{list(BASE)[k]}:{s}:{e}" for s, k, e in found)


def test_pii_base_equals_patterns(spark):
    rng = random.Random(11)
    alphabet = ["a", "b@c", ".", "..", "1", "12", "300", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (017) 555-7713", " ", "-", "+", "@", "é", "😀", "\n", "(", "x@y.z", "1.2.3.4", "_"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 25))) for _ in range(1500)] + ["1" * 5000, "a." * 5000 + "@" + "b." * 5000, "1.2.3.4" * 300, "+1" + " " * 9000]
    for r in pii.find_personal(docs(spark, texts)).collect():
        want = brute_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), texts[r.doc_id][:200]
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
        assert len(r.spans.split(",")) * bool(r.spans) == want.count(":") // 2 + r.n_further
        assert r.n_email == want.count("email:") and r.n_card == want.count("card:")


def test_em_prefers_the_better_labeler():
    post, right = pii.reliabilities([((1, 1, 1), 50.0), ((0, 0, 0), 50.0), ((0, 0, 1), 5.0), ((1, 1, 0), 5.0), ((1, None, None), 1.0)], (0.8, 0.8, 0.8))
    assert post[0] > 0.9 and post[1] < 0.1 and post[2] < 0.5 < post[3] and right[0] > right[2]


def test_em_finds_a_bad_labeler():
    """The third labeler is assumed as good as the others, but votes at random."""
    _, right = pii.reliabilities([((1, 1, 1), 40.0), ((1, 1, 0), 40.0), ((0, 0, 1), 40.0), ((0, 0, 0), 40.0)], (0.8, 0.8, 0.8))
    assert right[2] < 0.75 < 0.85 < right[0]


def test_further_spans_against_planted_ones(spark):
    """Precision and recall of what the method adds, over kinds, contexts and decoys."""
    rng = random.Random(43)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(64))
    area = lambda: rng.choice("23456789") + rng.choice("02345678") + rng.choice("23456789")
    number = lambda: f"({area()}) {rng.choice('23456789')}{digits(2)}-{digits(4)}"
    planted = [("secret", lambda: 'token = "', key), ("secret", lambda: "api_key: ", lambda: "AKIA" + "".join(rng.choice("ABCDEF0123456789") for _ in range(16))), ("email", lambda: "contact ", lambda: f"jane{digits(2)} (at) example (dot) com"), ("email", lambda: "mail ", lambda: f"bob{digits(2)}[at]mail[dot]example[dot]org"), ("phone", lambda: "call ", number), ("phone", lambda: "tel ", number)]
    decoys = [lambda: "sha256: " + key(), lambda: "commit " + key()[:40], lambda: f"order no 1{digits(2)}-{digits(3)}-{digits(4)}", lambda: "x" * 30, lambda: f"ref 0{digits(2)} 1{digits(2)} {digits(4)}", lambda: "isbn 978" + digits(10), lambda: "300.1.2.999", lambda: "4111 1111 1111 1112"]
    texts, want = [], []
    for i in range(400):
        if i % 2:
            kind, before, make = planted[i // 2 % len(planted)]
            head, body = "é word " + before(), make()
            texts.append(head + body + ' and "more')
            want.append(f"{kind}:{len(head)}:{len(head) + len(body)}")
        else:
            texts.append("words " + decoys[i // 2 % len(decoys)]() + " end")
            want.append("")
    texts += [f"plain mail to u{i}@mail.example.com, +1 (212) 555-{1000 + i} and 10.0.0.{i}" for i in range(100)]
    got = {r.doc_id: r for r in pii.find_personal(docs(spark, texts)).collect()}
    hit = sum(w in got[i].spans.split(",") for i, w in enumerate(want) if w)
    added = sum(got[i].n_further for i in range(len(texts)))
    assert hit >= 0.9 * sum(map(bool, want)) and hit >= 0.9 * added, (hit, added)


def test_pii_adds_obfuscated_mail(spark):
    texts = [f"mail to user{i}@mail.example.com now" for i in range(50)] + ["contact mail: jane (at) example (dot) com please", "nothing here 1.2.3.4.5"]
    r = {x.doc_id: x for x in pii.find_personal(docs(spark, texts)).collect()}
    assert r[50].n_email == 0 and r[50].spans.startswith("email:") and r[50].n_further == 1 and r[51].n_further == 0


# 5


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><b>";</script></head><body><nav><ul><li>Menu</li></ul></nav>
<div class="cookie-notice">Cookies</div><article><header>H</header><h1>Head&amp;amp;</h1><p><b>One<br>two<p>th<i>re</i>e&nbsp;&lt;x&gt;<div class="ad">Buy</div><form>f</form><section class="comments"><p>c</p></section></article><aside>A</aside><footer>F</footer></body></html>"""


def test_main_text(spark):
    pages = [PAGE, None, "", "<p>bare", "plain", "<article>a<", "<!-- x", "<div><p>" * 3000 + "deep"]
    df = spark.createDataFrame([(i, "http://h.com/", p, "x") for i, p in enumerate(pages)], "page_id long, url string, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in html_text.extract(df).collect()}
    assert got[0][0] == "Head&amp; One two three <x>" and [got[i][0] for i in range(1, 6)] == ["", "", "bare", "plain", "a<"] and got[7][0] == "deep"
    assert all(n == len(t) for t, n in got.values()) and html_text.extract(df.limit(0)).count() == 0


def extracted(page, templates=frozenset()):
    root = html_text.parse(page)
    html_text.digest(root)
    return html_text.main_text(root, html_text._protected(root, templates))


def test_no_article_text_is_lost():
    assert extracted("<p title=it's>Hello</p><p>it's done</p>") == "Hello it's done"
    assert extracted("1 < 2 and <b>3</b> <") == "1 < 2 and 3 <"
    assert extracted('<article><p class="share-price">up</p><p class="related">text</p><div class="ad-box">no</div></article>') == "up text"
    assert extracted("<article><header><h1>Title</h1><div>by me</div></header><p>body</p></article>") == "Title body"
    assert extracted("<a href='x>y</a> z") == "y z"


@pytest.mark.parametrize("part", ['<a "', "<a x='", "<", "<div></p>", "<li><ul><b>", "<!--", "<script>", "<a =", "<a " + " " * 99, "&#", "</", "<p/"])
def test_reading_time_follows_length(part):
    import time

    at = time.process_time()
    extracted(part * (300_000 // len(part)))
    assert time.process_time() - at < 10


def test_subtree_counts_equal_brute_force(spark):
    """Pages of unmarked blocks, without a class, id or article: what recurs goes, by counting texts of blocks."""
    rng = random.Random(37)
    blocks = [f"<div><ul><li>block {b} of site</li></ul></div>" for b in range(8)]
    pages = [(i, f"http://h{i % 3}.org/", [rng.choice(blocks[: 4 + i % 3]) for _ in range(2)], f"<div><div>own {i} text, longer than what else is here</div></div>") for i in range(60)]
    pages += [(100 + i, *p[1:]) for i, p in enumerate(pages[:10])]  # copies count once
    rows = [(i, u, f"<body>{b[0]}{own}{b[1]}</body>") for i, u, b, own in pages]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    n = {}
    for u, b, own in {(u, tuple(b), own) for _, u, b, own in pages}:
        for x in set(b):
            n[u, x] = n.get((u, x), 0) + 1
    for i, u, b, own in pages:
        keep = [own if x is own else x for x in (b[0], own, b[1]) if x is own or n[u, x] < 3]
        assert got[i] == " ".join(re.sub("<[^>]*>", "", x) for x in keep), i


def test_sentences_that_articles_share_stay(spark):
    page = lambda i: f"<div><ul><li>Site menu</li></ul></div><article><h1>T{i}</h1><p>Shared beginning.</p><div><ul><li>box</li></ul></div><p>{('text %d ' % i) * 9}</p><p>Shared end.</p></article>"
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame([(i, "http://h.org/", page(i)) for i in range(30)], "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"T{i} Shared beginning. {('text %d ' % i) * 9}Shared end." for i in range(30))


@pytest.mark.parametrize("most", [1000, -1])
def test_recurring_subtrees_go(spark, monkeypatch, most):
    monkeypatch.setattr(html_text, "MAX_BROADCAST", most)
    page = lambda i: f"<body><div><span>Same box</span></div><div>Own {i}</div><article><div>Box</div><p>Shared quote</p><p>Text {i}</p></article></body>"
    bare = lambda i: f"<body><div><span>Same box</span></div><div>Own {i}</div></body>"
    df = spark.createDataFrame([(i, "http://h.com/x", page(i)) for i in range(5)] + [(9, "http://h.com/x", bare(9)), (10, None, bare(10))], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    assert got[1] == "Shared quote Text 1" and got[9] == "Own 9" and got[10] == "Same box Own 10"


# 6


def test_exact_groups(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FIRST", 4)
    monkeypatch.setattr(exact_dedup, "GROWTH", 2)
    rng = random.Random(13)
    texts = ["".join(rng.choice("abAB") for _ in range(rng.choice([0, 3, 4, 5, 8, 9, 40]))) + rng.choice(["", "", "É", "é"]) for _ in range(150)] + ["q" * 16, "q" * 17, "Q" * 16]
    low = ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in texts]
    got = {r.doc_id: r for r in exact_dedup.exact_groups(docs(spark, texts)).collect()}
    for i, t in enumerate(low):
        same = [j for j, u in enumerate(low) if u == t]
        assert (got[i].keep_id, got[i].group_size, got[i].kept) == (max(same), len(same), i == max(same)) and got[i].text_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_repeated_rows_keep_one(spark):
    d = docs(spark, ["a", "A", "a", "b"], [7, 7, 7, 7])
    assert sorted(r.kept for r in exact_dedup.exact_groups(docs(spark, ["a", "a", "a"], [7, 7, 3])).collect()) == [False, False, True]
    out = exact_dedup.drop_copies(d)
    assert out.columns == d.columns and sorted(r.text.lower() for r in out.collect()) == ["a", "b"]


# 7


def brute_print(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in ([" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)])]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_fingerprints(spark):
    texts = [None, "", "One", "a B c d", "é É \x0b x", "w " * 9000]
    got = {r.doc_id: r.fingerprint for r in simhash.near_groups(docs(spark, texts)).collect()}
    assert got == {i: f"{brute_print(t):016x}" for i, t in enumerate(texts)}


@pytest.mark.parametrize("shard", [4096, 3])
def test_links_equal_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(simhash, "SHARD", shard)
    rng = random.Random(17)
    base = [rng.getrandbits(64) for _ in range(12)] + [0, (1 << 64) - 1]
    prints = list({b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (rng.random() < 0.5) * (1 << rng.randrange(64)) for b in base for _ in range(12)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2 and label[i] != label[j]:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    df = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash.group_fingerprints(df).collect()}
    assert [got[s] for s in signed] == label


def test_bk_tree_finds_all():
    rng = random.Random(19)
    values = [rng.getrandbits(12) for _ in range(300)]
    tree = simhash.BkTree()
    for v in set(values):
        tree.add(v)
    for q in values[:50]:
        assert sorted(tree.within(q, 2)) == sorted(v for v in set(values) if (v ^ q).bit_count() <= 2)


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r.v: r.label for r in components.components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100} and components.components(links.limit(0)).count() == 0


# 8


def test_licence_texts_and_notices(spark):
    mit = license_scan.TEXTS["MIT"]
    texts = ["Copyright (c) 2020 A\n\n" + mit.upper().replace("SUBLICENSE", "SUB-LICENCE"), "Prose here\nreleased under the  MIT Licence", mit + " x", None, "Released under the MIT License."]
    got = {r.doc_id: r for r in license_scan.scan(docs(spark, texts), license_scan.catalogue(spark)).collect()}
    assert [got[i].license_id for i in range(5)] == ["MIT", None, None, None, "MIT"] and [got[i].notice_ids for i in (1, 3)] == [["MIT"], []]


def test_licences_of_a_folder(spark, tmp_path):
    long = "\n\n".join(f"{i}. Clause {i} of the licence grants the commercial and non-commercial use of work {i}." for i in range(200))
    (tmp_path / "Long-1.0.txt").write_text("Copyright 2020 Somebody\n" + long)
    (tmp_path / "Other-2.0").write_text(long + "\nend")
    known = license_scan.catalogue(spark, str(tmp_path))
    texts = [long.upper().replace("LICENCE", "License"), long + " END.", long[:-30], license_scan.TEXTS["BSD-3-Clause"].replace("1. ", "* "), license_scan.TEXTS["Zlib"]]
    got = {r.doc_id: r.license_id for r in license_scan.scan(docs(spark, texts), known).collect()}
    assert got == {0: "Long-1.0", 1: "Other-2.0", 2: None, 3: None, 4: "Zlib"}


# 9


def brute_kneser_ney(texts, order):
    """(probability of a character after what stands before it, alphabet) by the textbook's recursion."""
    from collections import Counter

    counts = {order: Counter(x[i : i + order] for t in texts for x in [quality.PAD + t] for i in range(len(t)))}
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    alphabet = len(counts[1]) + 1

    def p(g):
        if not g:
            return 1 / alphabet
        n = len(g)
        have = Counter(counts[n].values())
        n1, n2, n3, n4 = (max(1, have[k]) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        d = [min(k, max(0.1, k - (k + 1) * y * a / b)) for k, a, b in ((1, n2, n1), (2, n3, n2), (3, n4, n3))]
        off = lambda c: d[min(c, 3) - 1]
        same = {h: c for h, c in counts[n].items() if h[:-1] == g[:-1]}
        if not same:
            return p(g[1:])
        total = sum(same.values())
        return (max(0, same[g] - off(same[g])) if g in same else 0) / total + sum(map(off, same.values())) / total * p(g[1:])

    return p, alphabet


def test_perplexities_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(quality, "PIECE", 40)
    monkeypatch.setattr(quality, "BLOCK", 90)
    monkeypatch.setattr(quality, "HELD", 50)
    texts = ["the cat sat on the mat. the cat", "a dog sat on the log", "Größe, die zählt 😀", None, "", "the cat sat on a log", "zzzqqq \x02\x02 é", "the dog" * 30]
    la = spark.createDataFrame([(0, 1, 0), (1, 1, 0), (2, 1, 0), (1, 1, 0), (5, 0, 0)], LABELS)
    p, alphabet = brute_kneser_ney([t for t in texts[:3]], quality.ORDER)
    got = {r.doc_id: r.perplexity for r in quality.judge(docs(spark, texts), la).collect()}
    for i, t in enumerate(texts):
        x = quality.PAD + (t or "")
        want = np.exp(-np.mean([np.log(p(x[k : k + quality.ORDER])) for k in range(len(t))])) if t else alphabet
        assert got[i] == pytest.approx(want, rel=1e-5), t
    assert sum(p("the " + c) for c in {*"".join(texts[:3]), "\x00"}) == pytest.approx(1)


def test_labels_beyond_the_broadcast(spark, monkeypatch):
    d, la = docs(spark, ["some words here", "other words", "x"]), spark.createDataFrame([(0, 1, 0), (1, 1, 0)], LABELS)
    few = rows(quality.judge(d, la))
    monkeypatch.setattr(quality, "MAX_TRUSTED", 0)
    assert rows(quality.judge(d, la)) == few


def test_junk_is_not_kept(spark):
    rng = random.Random(23)
    good = [" ".join(rng.choice(["the", "cat", "sat", "on", "mat", "and", "dog"]) for _ in range(60)) for _ in range(80)]
    junk = ["".join(rng.choice("%&#$|!xqzj") for _ in range(300)) for _ in range(10)]
    la = spark.createDataFrame([(i, 1, 0) for i in range(0, 80, 2)], LABELS)
    got = {r.doc_id: r.kept for r in quality.judge(docs(spark, good + junk), la).collect()}
    assert all(got[i] for i in range(0, 80, 2)) and sum(got[i] for i in range(80)) > 70 and not any(got[i] for i in range(80, 90))


# 10


def brute_leaks(texts, items):
    out = {}
    cut = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", (t or "").lower()) if w]
    for j, item in enumerate(items):
        w = cut(item)
        n = min(5, len(w))
        own = [tuple(w[i : i + n]) for i in range(len(w) - n + 1)] if w else []
        for i, t in enumerate(texts):
            d = cut(t)
            for s in range(len(d) - len(w) + 1) if own else ():
                part = d[s : s + len(w)]
                win = [tuple(part[a : a + n]) for a in range(len(part) - n + 1)]
                both = sum(min(win.count(x), own.count(x)) for x in set(own))
                if 9 * both >= 8 * len(own):
                    out[i, j] = max(out.get((i, j), 0), round(both / (2 * len(own) - both), 6))
    return out


def test_leaks_equal_brute_force(spark):
    rng = random.Random(29)
    words = [f"w{i}" for i in range(40)]
    item = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [item(n) for n in (1, 3, 5, 20, 33, 50, 50)] + ["w1 w2 " * 20, None, "", item(20)]
    texts = [item(60) for _ in range(10)] + [None, "", "w1"]
    for x in items[3:8] + items[3:8]:
        w = x.split()
        edit = w[:]
        edit[rng.choice([0, -1])] = "zzz"
        texts += [item(30) + " " + x.upper() + " " + item(9), item(4) + "\n" + " ".join(edit), " ".join(w[:-3]) + " " + item(30), x + "\t" + x]
    d = docs(spark, texts)
    b = spark.createDataFrame(list(enumerate(items)) + [(3, items[3])], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontamination.find_leaks(d, b).collect()}
    assert got == brute_leaks(texts, items)
    left = {r.doc_id for r in decontamination.drop_leaks(d, b).collect()}
    assert left == set(range(len(texts))) - {i for i, _ in got}
    assert decontamination.find_leaks(d, b.limit(0)).count() == 0 and decontamination.find_leaks(d.limit(0), b).count() == 0


def test_blocks_hold_all_within_the_radius(spark):
    rng = random.Random(41)
    base = [rng.getrandbits(63) for _ in range(40)]
    pairs = [(a, a ^ sum(1 << b for b in rng.sample(range(63), d))) for a in base for d in (0, 7, 14, 20)] + [(rng.getrandbits(63), rng.getrandbits(63)) for _ in range(400)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i long, a long, b long")
    left = df.select("i", F.posexplode(decontamination.blocks("a")).alias("k", "v"))
    right = df.select("i", F.posexplode(decontamination.blocks("b")).alias("k", "w")).select("i", "k", F.explode(decontamination.near_values(F.col("w"), F.col("k"))).alias("v"))
    found = {r.i for r in left.join(right, ["i", "k", "v"]).collect()}
    assert set(range(160)) <= found and len(found - set(range(160))) < 260  # about 45 % of unrelated pairs


def test_leaks_in_odd_rows(spark):
    b = spark.createDataFrame([(1, "same text here"), (None, "word word word word word word")], "item_id long, text string")
    d = docs(spark, ODD, [None, 1, 2, 3, 4, 5, 5, 6])
    assert {(r.doc_id, r.item_id) for r in decontamination.find_leaks(d, b).collect()} == {(5, 1), (4, None)}
    assert decontamination.drop_leaks(d, b).count() == len(ODD) - 3 and decontamination.drop_leaks(d, b).columns == d.columns
    minus = decontamination.find_leaks(docs(spark, ["same text here"] * 2, [-1, None]), b).collect()
    assert sorted((r.doc_id, r.item_id) for r in minus if r.doc_id) == [(-1, 1)] and len(minus) == 2
    assert decontamination.drop_leaks(docs(spark, ["same text here"], [None]).where(F.lit(True)), b).count() == 0


# near copies of the pipeline


def brute_near(texts):
    def cut(t):
        w = (t or "").lower().split()
        n = min(5, len(w))
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()

    sets, label = [cut(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both, either = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if (10 * both >= 8 * either) and label[i] != label[j]:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def test_near_copies_of_more_than_two_bits_are_dropped(spark):
    rng = random.Random(29)
    texts = [None, "", "one two", "One  two", "one two three"]
    for b in range(12):
        base = [f"w{b}x{rng.randrange(40)}" for _ in range(120)]
        texts.append(" ".join(base))
        for edits in (1, 2, 3, 5, 8):
            w = list(base)
            for _ in range(edits):
                w[rng.randrange(120)] = "changed"
            texts.append(" ".join(w))
    label = brute_near(texts)
    assert any(label[i] != i and (simhash.fingerprint(t) ^ simhash.fingerprint(texts[label[i]])).bit_count() > 2 for i, t in enumerate(texts) if t)
    got = {r.doc_id for r in simhash.keep_one(docs(spark, texts)).collect()}
    assert got == set(label) and len(got) < len(texts) - 20


def test_templates_by_distinct_pages_and_around_articles(spark):
    block = "<div><ul><li>one unmarked block</li></ul></div>"
    rows = [(i, "http://big.org/", f"<body>{block if i < 30 else ''}<p>text {i}</p></body>") for i in range(900)]
    copy = "<body><div><p>menu</p><article><div><div>the article of all copies</div></div><div>by me</div></article></div><p>{}</p></body>"
    rows += [(1000 + i, "http://a.org/", copy.format(i)) for i in range(5)]  # differ outside the article
    rows += [(2000 + i, "http://b.org/", "<body><div><ul><li>whole page</li></ul></div></body>") for i in range(5)]  # one page, five times
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[i] for i in range(900)] == [f"text {i}" for i in range(900)]
    assert all("the article of all copies" in got[1000 + i] for i in range(5))
    assert all(got[2000 + i] == "whole page" for i in range(5))


def test_one_id_on_two_texts_does_not_join_components(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    got = rows(simhash.keep_one(docs(spark, [a, b, a + " x", b + " x"], [1, 1, 2, 3])).select("doc_id", "text"))
    assert sorted(got) == sorted([(1, a), (1, b)])


def test_no_id_stands_for_null(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    got = sorted(rows(simhash.keep_one(docs(spark, [a, b, a, a + " x"], [-1, None, None, 3])).select("doc_id", "text")), key=repr)
    assert got == [(-1, a), (None, b)]


FORMS = ["<svg/>", "<math/>", "<svg viewBox='0 0 1 1'/>", "<!-->", "<!--->", "<!-- x --!>", "<!-- a > b -- c -->", "<!---->", "<?x y?>", "<br/>", "<svg><path d='M0 0'/><title>t</title></svg>", "<math><mi>x</mi></math>", "<script>if (a < b) '</p>'</script>", "<style>p > a {}</style>"]


@pytest.mark.parametrize("form", FORMS)
def test_what_follows_an_odd_form_stays(form):
    assert extracted(f"<article><p>One {form} two</p><p>three</p></article>") == "One two three"
    assert extracted(f"<p>a</p>{form}<p>b</p>") == "a b"


def test_pages_of_odd_forms_are_read_in_linear_time():
    import time

    for form in ("<!-- ", "<!-->", "<!-- --!>", "<svg>", "<svg/>", "<math", "--!>", "<!--->"):
        began = time.process_time()
        extracted(form * (1_000_000 // len(form)))
        assert time.process_time() - began < 20, form


def random_page(rng):
    """(html, its main text): made side by side, so that the text does not come from any parser."""
    words = ["one", "two", "a &amp; b", "&lt;p&gt;", "caf&eacute;", "x\n  y", "&#8364;5", "1 < 2"]
    plain = {"a &amp; b": "a & b", "&lt;p&gt;": "<p>", "caf&eacute;": "café", "x\n  y": "x y", "&#8364;5": "€5"}
    said = lambda ws: " ".join(plain.get(w, w) for w in ws)

    def inline(depth=0):
        ws = [rng.choice(words) for _ in range(rng.randint(1, 4))]
        markup = " ".join(rng.choice(["@", "<b>@</b>", "<a href='/x?a=1&b=2' title=\"q > p\">@</a>", "@" + rng.choice(FORMS)]).replace("@", w) for w in ws)
        return markup, said(ws)

    def block(depth):
        kind = rng.choice(["p", "h2", "div", "ul", "gone", "section"] if depth else ["p", "h2"])
        if kind == "gone":
            text = inline()[0]
            return rng.choice(["<nav>{}</nav>", "<aside><p>{}</p></aside>", "<form><input value='v'>{}</form>", "<div class='comments'><p>{}</p></div>", "<div role='navigation'>{}</div>", "<footer>{}</footer>", "<div class='ad-box'>{}</div>"]).format(text), []
        if kind in ("p", "h2"):
            markup, text = inline()
            return f"<{kind}>{markup}" + ("" if kind == "p" and rng.random() < 0.3 else f"</{kind}>"), [text]
        if kind == "ul":
            items = [inline() for _ in range(2)]
            return "<ul>" + "".join(f"<li>{m}" + rng.choice(["", "</li>"]) for m, _ in items) + "</ul>", [t for _, t in items]
        inner = [block(depth - 1) for _ in range(rng.randint(1, 3))]
        return f"<{kind}>" + "".join(m for m, _ in inner) + f"</{kind}>", [t for _, ts in inner for t in ts]

    blocks = [block(2) for _ in range(rng.randint(1, 5))]
    head, foot = inline()[0], inline()[0]
    page = f"<!DOCTYPE html><html><head><title>{head}</title></head><body><header><p>{head}</p></header><article>{''.join(m for m, _ in blocks)}</article><footer><p>{foot}</p></footer></body></html>"
    return page, " ".join(t for _, ts in blocks for t in ts)


def test_texts_of_random_pages():
    rng = random.Random(11)
    for _ in range(2000):
        page, text = random_page(rng)
        assert extracted(page) == text, page


def test_url_filter_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([("http://a.org/", 1, "x", 2, "old")], "url string, _hit int, row string, hit int, rule string")
    got = url_filter.judge_urls(df, URL_RULES).first()
    assert (got._hit, got.row, got.hit, got.rule, got.verdict) == (1, "x", 2, "org/", "allow")
    many = URL_RULES + [(f"h{i}.net", "/", "block") for i in range(url_filter.MAX_RULES)]
    got = url_filter.judge_urls(df, many).first()
    assert (got._hit, got.row, got.hit, got.rule) == (1, "x", 2, "org/")


def test_hashes_are_found_by_their_first_bits():
    """Places.of and the sorted look-ups give what searchsorted and unique give, for few, many and crowded hashes."""
    import numpy as np

    from tessera.llm import quality

    rng = np.random.default_rng(5)
    for known in (rng.integers(0, 1 << 64, 5000, np.uint64), np.arange(7, 900, dtype=np.uint64), np.array([0], np.uint64), np.array([(1 << 64) - 1, 3], np.uint64)):
        known = np.unique(known)
        asked = rng.choice(known, 20_000)
        assert (quality.Places(known).of(asked) == np.searchsorted(known, asked)).all()
        assert (quality._different(asked) == np.unique(asked)).all()
    assert len(quality._different(np.empty(0, np.uint32))) == 0
