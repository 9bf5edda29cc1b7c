"""Packing, secrets, decontamination, pages and chat against plain forms."""

import hashlib
import html
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from stockledger.llm import chat, decontaminate, packing, pages, secrets

from .conftest import frame


def test_packing_is_a_gapless_cut_of_the_tokens(spark, edge_texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    texts = [*edge_texts, "a  b", "x\n\ny \n z", " lead", "trail ", "tab\tq", "it's don't, ok.", "..", "1.2,3 4", "<|endoftext|> a", "日本語。 x", "A B.\nC, d"]
    found = packing.pack(frame(spark, texts).repartition(3), with_ids=True).collect()
    for n, text in enumerate(texts):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted((r for r in found if r.doc_id == n), key=lambda r: r.start)
        assert [x for r in own for x in r.ids] == ids and all(r.doc_tokens == len(ids) for r in own)
        assert [r.start for r in own] == np.cumsum([0, *[r.length for r in own[:-1]]]).tolist()
        assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in own)
    spans = sorted((r.sequence_id * 1024 + r.offset, r.length) for r in found)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and spans[0][0] == 0
    assert all(r.offset + r.length <= 1024 for r in found)


def test_packing_edges(spark):
    assert packing.pack(frame(spark, [])).count() == 0
    assert packing.pack(frame(spark, [None, ""]), end_id=None).count() == 0
    twice = packing.pack(frame(spark, ["a b", "a b", None], [1, 1, None]))
    assert rows(twice, "doc_id", "length") == [(1, 3), (1, 3), (None, 1)]


def plain_spans(text):
    names = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in x) for x in ("password", "passwd", "secret", "token"))
    assign = re.compile(rf"""({names}|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(found + [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


SECRETS = [
    'é token = "0123456789abcdef0123456789abcdef" and more', "PassWord:hunter22 secret: token = abcdefgh", "AKIA" + "A" * 16 + " AKIAAKIA" + "B" * 12 + " AKIA1", "api_key='x'", "APIKEY==abcdef",
    "f" * 24 + " " + "a" * 23, "日本 passwd = 'αβγ' secret=ok-1.2/3", "token:" + "9" * 30, None, "", "nothing",
]


def test_secrets_equal_plain_patterns(spark):
    docs = frame(spark, SECRETS)
    found, ledger = secrets.find_secrets(docs, rules=secrets.BASE_RULES)
    got = {r.doc_id: [(s["start"], s["rank"], s["kind"], s["end"]) for s in r.spans] for r in found.collect()}
    assert got == {i: plain_spans(x or "") for i, x in enumerate(SECRETS)}
    text = found.select("doc_id", secrets.spans_text(F.col("spans")).alias("t")).collect()
    assert dict(map(tuple, text))[0] == "assign:2:43,hex:11:43"
    for r in secrets.redact(docs).collect():
        assert (r.text is None) == (SECRETS[r.doc_id] is None)
        assert r.doc_id > 7 or r.doc_id == 3 or "[SECRET]" in r.text
    assert {r.doc_id: r.text for r in secrets.redact(docs).collect()}[0] == 'é [SECRET]" and more'


def test_ledger_scans_only_what_is_unseen(spark):
    first, ledger = secrets.find_secrets(frame(spark, SECRETS[:4]), rules=secrets.BASE_RULES)
    again, second = secrets.find_secrets(frame(spark, SECRETS), ledger, rules=secrets.BASE_RULES)
    assert second.count() == ledger.count() + 3 * len(set(x or "" for x in SECRETS[4:]))
    want, _ = secrets.find_secrets(frame(spark, SECRETS), rules=secrets.BASE_RULES)
    assert sorted(map(str, again.collect())) == sorted(map(str, want.collect()))
    newer = (*secrets.BASE_RULES[:2], secrets.Rule("hex", "[0-9a-f]+", 0, 23, "[0-9a-f]{23}", version="2"))
    found, third = secrets.find_secrets(frame(spark, SECRETS), second, rules=newer)
    assert third.count() == second.count() + len(set(x or "" for x in SECRETS))
    assert sum(s["kind"] == "hex" for r in found.collect() for s in r.spans) == 4
    assert secrets.find_secrets(frame(spark, []))[0].count() == 0


def plain_shingles(text):
    words = [w for w in re.split("[" + re.escape(decontaminate.SEPARATORS.decode()) + "]+", (text or "").lower()) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def holds(item, text):
    """Whether a text has 0.8 of an item's five-word shingles, or an item of fewer words in a row."""
    split = lambda x: re.findall(r"[^\x00-\x20!-/:-@\[-`{-~]+", (x or "").lower())
    words, inside = split(item), split(text)
    if len(words) < 5:
        return any(inside[i : i + len(words)] == words for i in range(len(inside) - len(words) + 1)) if words else False
    sought = plain_shingles(item)
    return len(sought & plain_shingles(text)) >= 0.8 * len(sought)


def test_leaks_equal_exact_containment(spark):
    rng = np.random.default_rng(2)
    word = lambda: f"w{rng.integers(0, 400)}"
    items = [" ".join(word() for _ in range(n)) for n in (3, 5, 6, 9, 15, 22, 40, 59, 130)] + [None, "", "...", "Déjà vu, this is it", "Rare!", "two words", "two words", "w7", "one of four, words"]
    texts = [None, "", "w1 w2", items[0], "RARE", "a rare two  words", "two, words two words", "two wordss", "it is one of four words here", "one of four", "y " * 2_000 + "rare"]
    for item in items[1:9]:
        words = item.split()
        for cut in (0, 1, len(words) // 10, len(words) // 4, len(words) // 2):
            filler = [word() for _ in range(int(rng.integers(0, 900)))]
            at = int(rng.integers(0, len(filler) + 1))
            texts.append(" ".join([*filler[:at], *words[cut:], *filler[at:]]))
    texts += ["x DÉJÀ vu this, is IT y", texts[14], texts[14]]
    docs = frame(spark, texts)
    bench = spark.createDataFrame([(i, x, 1) for i, x in enumerate(items)], "item_id int, text string, doc_id int")
    want = {(d, i) for d, t in enumerate(texts) for i, x in enumerate(items) if plain_shingles(x) and holds(x, t)}
    got = decontaminate.find_leaks(docs, bench)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want and len(want) > 20
    kept = decontaminate.drop_leaks(docs, bench)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(range(len(texts))) - {d for d, _ in want})
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0 and decontaminate.drop_leaks(frame(spark, []), bench).count() == 0


def test_leaks_in_blocks_of_items(spark, monkeypatch):
    items = spark.createDataFrame([(i, " ".join(f"a{i}b{k}" for k in range(12))) for i in range(30)], "item_id long, text string")
    docs = items.selectExpr("item_id as doc_id", "concat('lead ', text, ' tail') as text")
    monkeypatch.setattr(decontaminate, "item_blocks", lambda items, a, b, f=decontaminate.item_blocks: f(items, a, b, most=8))
    assert rows(decontaminate.find_leaks(docs, items), "doc_id", "item_id") == rows(items.selectExpr("item_id as a", "item_id as b"))


PAGE = """<!DOCTYPE html><html><head><title>T &amp; U</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><p>Site name and slogan here</p></header><nav><ul><li><a href="/a">Home page</a></li><li><a href="/b">News</a></li></ul></nav>
<div class="ad">Buy this now please do</div><aside><p>Side text with many words in it</p></aside><div class="main-nav"><p>Go to</p></div><div id="cookie-notice"><p>We use cookies</p></div>%s<form><p>Sign up here</p></form>
<section class="comments"><p>I liked it a lot, thank you very much</p></section><footer>&copy; someone</footer></body></html>"""
BODY = "<h1 class='article-header'>Title\n of it</h1><p><b>One &lt;two&gt;&nbsp;three<br>four</b><!-- <p>never</p> --><p>Five  six\tseven</p><div class='promo'>Offer</div><ul><li>eight</li><li>nine ten</li></ul>"
TEXT = "Title of it\nOne <two> three four\nFive six seven\neight\nnine ten"


def test_pages_give_the_article(spark):
    marked = [PAGE % f"<article>{BODY}</article>" for _ in range(30)]
    rest = [None, "", "plain words only", PAGE % f"<article>{BODY}</article>", PAGE % f"<div id=text>{BODY * 3}</div>", "<p>open <b>end", "<article>" + "x " * 50_000]
    raw = spark.createDataFrame([(i, f"u{i}", x, "t") for i, x in enumerate([*marked, *rest])], "page_id long, url string, html string, text string")
    weights = pages.learn_weights(raw)
    got = {r.page_id: r for r in pages.extract(raw, weights).collect()}
    text = [got[i].text for i in range(30, 37)]
    assert text[:4] == ["", "", "plain words only", TEXT]
    assert "Title of it" in text[4] and "eight\nnine ten" in text[4] and "Home" not in text[4] and "liked" not in text[4] and "Offer" not in text[4]
    assert text[5] == "open end" and text[6] == " ".join(["x"] * 50_000)
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert pages.extract(raw.limit(0), pages.learn_weights(raw.limit(0))).count() == 0


PAGES = "/root/testdata/sf0.01/pages.parquet"


def plain_article(page):
    """The text of the one article element by plain patterns, for pages of simple markup."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:h1|p|ul|li|div)\b[^>]*>", inner)
    lines = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", x.replace("<br>", "\n"))).split()) for x in blocks)
    return "\n".join(x for x in lines if x)


def test_all_pages_equal_the_plain_form(spark):
    raw = spark.read.parquet(PAGES)
    want = {r.page_id: plain_article(r.html) for r in raw.collect()}
    assert {r.page_id: r.text for r in pages.extract(raw, pages.learn_weights(raw)).collect()} == want


def test_learned_weights_leave_out_boilerplate_under_any_name(spark):
    """Held-out pages without the marks of content, whose classes were renamed at random."""
    raw = spark.read.parquet(PAGES)
    weights = pages.learn_weights(raw.filter("page_id % 2 = 0"))
    rng, hit, there, given = random.Random(3), 0, 0, 0
    for r in raw.filter("page_id % 2 = 1").collect():
        bare = re.sub(r"</?(?:article|main)\b[^>]*>", "", r.html)
        bare = re.sub(r'(?:class|id|role)="[^"]*"', lambda _: f'class="{"".join(rng.choices("bcdfgqxz", k=7))}"', bare)
        want, got = Counter(plain_article(r.html).split()), Counter(pages.main_text(bare, weights).split())
        hit, there, given = hit + (want & got).total(), there + want.total(), given + got.total()
    assert hit >= 0.9 * there and hit >= 0.9 * given and there > 1000


@pytest.mark.parametrize(
    "page",
    ["<a " * 350_000, "<b>" * 350_000, "<a '>'" * 170_000 + '"', "<p class='" + "ad!-" * 250_000 + "'>x", "<!--" * 250_000, "</b>" * 250_000,
     "<script>" * 120_000, "<" * 1_000_000, "</" * 500_000 + ">", "<p " + "class=" * 160_000 + ">t", '<a ">' * 200_001, "&#" + "1" * 1_000_000 + ";"],
    ids=lambda x: x[:12],
)
def test_odd_pages_take_linear_time(page):
    start = time.perf_counter()
    pages.main_text(page, pages.Weights({}))
    assert time.perf_counter() - start < 5


def test_odd_markup_keeps_its_text(spark):
    weights = pages.Weights({})
    cases = {
        "a < b <p>c d e": "a < b\nc d e", "one <two": "one <two", '<p title="a>b">x</p>': "x", '<p title="a>x': "x", "<P>x<script>if (a<b) '</p>'</SCRIPT >y": "xy",
        "&#65;&#x000000041;&#00000000000066;&#9999999999999;": "AAB\ufffd", "<p>x<!-- open <p>y": "x", "<?x?><!y>z</>": "z", "<title>t</title>x": "x",
    }
    assert {x: pages.main_text(x, weights) for x in cases} == cases
    raw = spark.createDataFrame([(None, None, "<p>x", "a"), (None, None, "<p>x", "b"), (1, "u", None, None)], "page_id long, url string, html string, text string")
    assert rows(pages.extract(raw, weights)) == rows(spark.createDataFrame([(None, None, "x", 1), (None, None, "x", 1), (1, "u", "", 0)], "a long, b string, c string, d long"))


def test_best_region_equals_all_regions():
    rng = np.random.default_rng(1)
    for _ in range(50):
        x = rng.integers(-3, 4, 12).tolist()
        a, b = pages.best_region(x)
        assert sum(x[a:b]) == max([0, *[sum(x[i:j]) for i in range(12) for j in range(i + 1, 13)]])


TALKS = "/root/testdata/sf0.01/conversations.parquet"


@pytest.fixture
def talks(spark):
    return chat.raw_transcripts(spark.read.parquet(TALKS))


def test_chat_recovers_roles(spark, talks):
    model = chat.learn(chat.lines_of(talks, label_col="role"))
    got = {(r.conv_id, r.turn): r for r in chat.parse(talks, model).filter("line = 0").collect()}
    truth = spark.read.parquet(TALKS).collect()
    right = sum((r.conv_id, r.turn) in got and got[r.conv_id, r.turn].role == r.role for r in truth)
    assert right >= 0.95 * len(truth)
    one = next(iter(got.values()))
    assert one.rendered == f"<|{one.role}|>\n{one.text}\n<|end|>\n"


def test_chat_in_blocks_equals_one_run(spark, talks, monkeypatch):
    model = chat.learn(chat.lines_of(talks, label_col="role"))
    begun = lambda df: rows(df.filter("not continued"), "conv_id", "turn", "line", "role")
    whole = begun(chat.parse(talks, model, block=10**6))
    monkeypatch.setattr(chat, "BLOCK", 2)
    assert begun(chat.parse(talks, model, block=2)) == whole


def test_chat_edges(spark):
    data = [(1, 0, "user", "User: hi"), (1, 0, "user", "User: hi"), (1, 1, "assistant", "Assistant: yes"), (None, None, None, None), (2, 5, "user", ""), (2, 5, "user", "User: tie")]
    messages = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    model = chat.learn(chat.lines_of(messages, label_col="role"))
    assert chat.parse(messages, model).filter("conv_id = 1").count() == 2
    assert chat.parse(messages.limit(0), chat.learn(chat.lines_of(messages.limit(0), label_col="role"))).count() == 0


def test_sha_of_no_span_is_that_of_the_empty_text(spark, sf):
    from stockledger.llm.queries import op7_secret_scans

    empty = [r for r in op7_secret_scans(spark, sf).collect() if not r.spans]
    assert empty and all(r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in empty)


def test_chat_keeps_every_marker_with_support(spark):
    """More than 400 different speakers of one turn each: every marker is counted and stripped."""
    names = [f"{a}{b}" for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for b in "abcdefghijklmnopqrst"]
    data = [(n, t, role, f"{name}: some words of turn {t}") for n, name in enumerate(names) for t, role in enumerate(("user",))]
    raw = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    model = chat.learn(chat.lines_of(raw, label_col="role"))
    assert len(model.speakers) == len(names) > 500
    few = chat.learn(chat.lines_of(raw, label_col="role"), support=100)
    assert not few.speakers
