"""Page extraction and secret scans."""

import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

from sievework.llm import html_extract, secrets
from sievework.llm.html_extract import shared, text_of

MAKE = "page_id long, url string, html string"


def longest(a, b):
    grid = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            grid[i + 1][j + 1] = grid[i][j] + 1 if x == y else max(grid[i][j + 1], grid[i + 1][j])
    return grid[-1][-1]


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(500):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(12))] for _ in range(2))
        kept = [a[i] for i in sorted(shared(a, b))]
        rest = iter(b)
        assert len(kept) == longest(a, b) and all(x in rest for x in kept)
        split = [a[i] for i in sorted(shared(a, b, most_bits=4))]
        rest = iter(b)
        assert len(split) == longest(a, b) and all(x in rest for x in split)


def test_broken_pages_and_long_texts_take_linear_time():
    began = time.time()
    for piece in ('<a x="', "<a ", "<a", "<!", "<head>", "<!--", "</p", "<p x='>"):
        text_of(piece * (1_000_000 // len(piece)))
    assert len(shared([i % 9973 for i in range(20000)], [i % 9967 for i in range(20000)])) > 0
    assert secrets.brute_force("eyJ" * 300_000) == [] and time.time() - began < 90


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple &am", "plain & simple &am"),
        ("<body><nav>m</nav><article><h1>A&nbsp; B</h1><p><b>one<br><p>two\n three</article><footer>f</footer>", "A B\none\ntwo three"),
        ("<article><header><h1>T</h1></header><p>x</p><aside>s</aside><div class='post-comments'><p>c</p></div><form>q</form><footer>f</footer></article>", "T\nx"),
        ("<div id=main-nav>m</div><div class='ad'>a</div><p>x <span class=\"share\">tweet</span> y", "x\ny"),
        ("<script>var t='</p>';</script><style>p{}</style><p>x<!-- <p>no --></p><noscript>n</noscript>", "x"),
        ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
        ("<p>" + "long " * 40000 + "</p>", ("long " * 40000).strip()),
    ],
)
def test_blocks(page, text):
    assert text_of(page) == text


def page(i, *lines):
    return "<body>" + "".join(f"<p>{x}</p>" for x in ("Site menu", *lines, "All rights")) + "</body>"


def test_shared_lines_go_unless_the_partner_is_a_copy(spark):
    rows = [(1, "http://h.org/a/1", page(1, "first text", "more of it")), (2, "http://h.org/a/2?x=1", page(2, "second text")), (3, "http://h.org/b", page(3, "third")), (4, "http://alone.org/x", page(4, "only")), (5, "http://c.org/1", page(5, "same", "same2", "same3")), (6, "http://c.org/2", page(5, "same", "same2", "same3")), (7, None, None), (8, "http://q", "")]
    for parts in (1, 8):  # where ranges end doesn't matter
        got = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(rows, MAKE).repartition(parts)).collect()}
        assert got[1] == "first text\nmore of it" and got[2] == "second text" and got[3] == "third"
        assert got[4] == "Site menu\nonly\nAll rights"
        assert got[5] == got[6] == "Site menu\nsame\nsame2\nsame3\nAll rights"
        assert got[7] == got[8] == ""


def test_alignment_decides_lines_that_no_text_element_of_an_article_holds(spark):
    def article(*lines):
        return "<nav>Home</nav><article><h1>Quoted title</h1>" + "".join(f"<p>{x}</p>" for x in lines) + "<p>Quoted by all</p><div>Join our list today</div><div>bare " + lines[0] + "</div></article>"

    rows = [(i, f"http://h.org/a/{i}", article(f"text {i}", f"more {i}", f"end {i}")) for i in range(12)]
    for parts in (1, 4):
        got = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(rows, MAKE).repartition(parts)).collect()}
        assert got == {i: f"Quoted title\ntext {i}\nmore {i}\nend {i}\nQuoted by all\nbare text {i}" for i in range(12)}
    assert text_of("<article>loose<h2>head</h2>more<ul><li>item</ul></article><p>out") == "loose\nhead\nmore\nitem"


def test_pages_edge_cases(spark):
    empty = spark.createDataFrame([], MAKE + ", text string, key long")
    out = html_extract.extract(empty)
    assert out.columns == ["page_id", "url", "html", "key", "text", "n_chars"] and out.count() == 0
    rows = [(1, "http://h/1", "<p>a</p>", "old", 5)] * 3
    again = html_extract.extract(spark.createDataFrame(rows, MAKE + ", text string, key long")).collect()
    assert [(r["text"], r["n_chars"], r["key"]) for r in again] == [("a", 1, 5)] * 3


def test_trigram_queries():
    q = secrets.trigram_query
    assert q("abcd") == [frozenset({"abc", "bcd"})]
    assert q("(?:foo|barn)x*") == sorted([frozenset({"foo"}), frozenset({"bar", "arn"})], key=sorted)
    assert q("[0-9a-f]{16,}") is None and q("ab?c?") is None
    assert q("x(?:yz)?[0-9]+abc") == [frozenset({"abc"})]
    assert q("(?:abc){2}") is not None
    for rule in secrets.RULES:
        assert (q(rule.pattern) is None) == (rule.kind == "hex")


def planted(rng):
    words = ["token", "secret =", "password:", "API_KEY=\"", "api-key", "AKIA", "akia", "ghp_", "sk-", "eyJ", "é", "😀", "0123abcd" * 3, "A1B2C3D4E5F6G7H8", "xoxb-", "AIza", "-----BEGIN RSA PRIVATE KEY-----", " ", "\n", "'", ":", "=", "Zz9/+=._-" * 2, "tokentoken", "dead" * 5]
    return "".join(rng.choice(words) for _ in range(rng.randrange(60)))


def test_spans_match_brute_force(spark):
    rng = random.Random(11)
    texts = [planted(rng) for _ in range(400)] + [None, "", "x" * 200000 + " password=abcdef123456 " + "y" * 100000, "token=secret: \"abcdefghijklmnop\""]
    found = secrets.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(found) == len(texts)
    for r in found:
        assert [(s["start"], s["rank"], s["end"], s["kind"]) for s in r["secret_spans"]] == secrets.brute_force(texts[r["doc_id"]])


def test_digest_and_redaction(spark):
    text = "a password=b7db7aa4a5fcc78305 b"
    df = secrets.find(spark.createDataFrame([(1, text), (2, "clean"), (3, None)], "doc_id long, text string"))
    r = df.select("doc_id", secrets.joined(F.col("secret_spans")).alias("s")).orderBy("doc_id").collect()
    assert r[0]["s"] == "assign:2:29,hex:11:29" and r[1]["s"] == "" and hashlib.sha256(b"").hexdigest().startswith("e3b0")
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(df).collect()}
    assert clean == {1: "a [secret] b", 2: "clean", 3: None}


def test_secrets_edge_cases(spark):
    cols = "doc_id long, text string, secret_spans string, gram int"
    assert secrets.find(spark.createDataFrame([], cols)).count() == 0
    rows = [(1, "AKIA" + "Z" * 16, "old", 3)] * 2 + [(None, "AKIA" + "Z" * 16, None, None)]
    out = secrets.find(spark.createDataFrame(rows, cols)).collect()
    assert len(out) == 3 and all(len(r["secret_spans"]) == 1 for r in out) and sorted(r["gram"] or 0 for r in out) == [0, 3, 3]


def test_secrets_plan_has_no_python(spark):
    plan = secrets.find(spark.createDataFrame([(1, "x")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "ArrowEval" not in plan
