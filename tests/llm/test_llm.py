"""Every operator against a brute-force version, and on nulls, empty and long texts, repeats and clashing names."""

import hashlib
import itertools
import os
import re
import time
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tableprofile.llm import chat, exact, html, langid, mixing, pieces, quality, suffix, superminhash, textbytes, topk
from tableprofile.llm.common import FILE_ROWS, components, saved, shared_folder
from tableprofile.llm.queries import MODEL_FILE, QUERIES
from tableprofile.llm.sql import ORACLES
from tools.compare import TABLES, canonical

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SPACES = re.compile(r"[\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


LONG = "one two three four five six seven eight nine ten " * 4000
EDGE = [
    (1, "The cat  sat on the mat and the dog lay on the rug by the fire.", "en", "a"), (2, None, None, None), (3, "", "en", "a"),
    (4, "The cat sat on the mat and the dog lay on the rug by the fire.", "en", None), (5, LONG, "en", "b"), (5, LONG, "en", "b"),
    (None, "no id here", "en", "b"), (6, "▁ é中\U0001F600 %7C <| 12", "fr", "c"), (7, "   \n\t", None, "c"), (8, "ZZZ", "de", "c"),
]


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls everywhere, empty and long texts, a repeated row, and columns named like internal ones."""
    rows = [(*r, *([7] * 8)) for r in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, id long, key long, n long, mix long, hash long, component long, quality long, language long")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, db, name):
    frame = QUERIES[name](spark, FOLDER)
    result = db.execute(ORACLES[name])
    assert canonical(frame.columns, frame.collect()) == canonical([c[0] for c in result.description], result.fetchall())


def test_exact_edges(spark, edge):
    got = {r["doc_id"]: r for r in exact.exact_groups(edge).collect()}
    assert len(exact.exact_groups(edge).collect()) == len(EDGE)
    assert got[4]["keep_id"] == 1 and not got[4]["kept"] and got[1]["group_size"] == 2
    assert got[2]["keep_id"] == 2 and got[3]["keep_id"] == 2 and got[5]["group_size"] == 2 and got[5]["kept"]
    assert got[7]["text_sha256"] == hashlib.sha256(b" ").hexdigest()
    assert exact.exact_groups(edge.limit(0)).collect() == []


def shared_files(spark) -> set[str]:
    """Part files in the shared folder; Hadoop starts a process for every file that an executor writes there."""
    return {f"{d}/{x}" for d, _, names in os.walk(shared_folder(spark).removeprefix("file://")) for x in names if x.startswith("part-")}


def test_exact_writes_no_files(spark, edge):
    before = shared_files(spark)
    assert len(exact.exact_groups(edge).collect()) == len(EDGE) and shared_files(spark) == before


def test_trie_emptied_when_full(spark):
    texts = [f"{'x' * (i % 50)}{i % 300}".encode() for i in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text binary")
    want = {}
    for i, t in enumerate(texts):
        want.setdefault(t, [i, 0])[1] += 1
    for room in (1, 5_000, 1 << 20):
        got = exact.text_owners(df, max_trie_bytes=room).collect()
        assert sorted((bytes(r["text"]), r["owner"], r["copies"]) for r in got) == sorted((t, *v) for t, v in want.items())


def test_signature_estimates_similarity():
    rng = np.random.default_rng(3)
    for n in (1, 3, 40, 2000):
        a, b = rng.integers(0, 2**63, (2, n)).astype(np.uint64)
        shared = n // 2
        b[:shared] = a[:shared]
        sa, sb = superminhash.signature(a, 256), superminhash.signature(b, 256)
        assert abs(np.mean(sa == sb) - shared / (2 * n - shared)) < 0.15
        assert (superminhash.signature(rng.permutation(a), 256) == sa).all() and len(sa) == 256


def test_near_group_of_chained_edits(spark):
    """A chain whose ends are not similar is one group; a member with too many edits stays alone."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        for j in rng.choice(400, 4 if i < 55 else 60, replace=False):
            words[j] = f"e{i}x{j}"
        rows.append((100 + i, " ".join(words)))
    sets = {i: {tuple(t.split()[j : j + 5]) for j in range(396)} for i, t in rows}
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(root, 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = superminhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: find(i) for i in root}


def test_near_edges(spark, edge):
    got = {r["doc_id"]: r for r in superminhash.near_groups(edge, words=3, percent=85).collect()}
    assert got[4]["component_id"] == 1 and not got[4]["kept"] and got[2]["n_shingles"] == 0 and got[3]["component_id"] == 3
    assert got[8]["n_shingles"] == 1 and got[None]["component_id"] is None and got[None]["kept"] and got[5]["n_shingles"] == 10
    assert superminhash.near_groups(edge.limit(0)).collect() == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 50), (50, 70), (7, 7)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 50: 50, 70: 50, 100: 50}


def test_components_write_few_files(spark):
    """Tables of known size are in files of many rows, whatever the number of partitions."""
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 200)], "a long, b long").repartition(4)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        before = shared_files(spark)
        assert {r["component"] for r in components(edges).collect()} == {1}
        folders = Counter(os.path.dirname(x) for x in shared_files(spark) - before)
    finally:
        spark.conf.unset(coalesce)
    assert sorted(folders.values())[:-2] == [1] * (len(folders) - 2) and len(folders) > 4  # edges and first labels come first
    df = spark.range(0, FILE_ROWS + 1, 1, 4).select(F.col("id").alias("a"))
    before = shared_files(spark)
    assert saved(df, FILE_ROWS + 1).agg(F.sum("a")).first()[0] == FILE_ROWS * (FILE_ROWS + 1) // 2 and len(shared_files(spark) - before) == 2


def removed(texts: dict) -> dict:
    seen, out = set(), {}
    for i in sorted(texts):
        b = texts[i]
        mask = bytearray(len(b))
        for s in range(len(b) - 99):
            if b[s : s + 100] in seen:
                mask[s : s + 100] = b"\1" * 100
            seen.add(b[s : s + 100])
        spans = sum(m and (j == 0 or not mask[j - 1]) for j, m in enumerate(mask))
        out[i] = (len(b), sum(mask), spans, hashlib.sha256(bytes(x for x, m in zip(b, mask) if not m)).hexdigest())
    return out


def test_suffix_brute_force(spark, db):
    texts = {i: (t or "").encode() for i, t in db.execute("SELECT doc_id, text FROM documents").fetchall()}
    texts |= {10**6: b"ab" * 300, 10**6 + 1: b"x" + b"ab" * 60, 10**6 + 2: bytes(range(32, 127)) * 3, 10**6 + 3: b"q" * 99, 10**6 + 4: b"q" * 99}
    df = spark.createDataFrame([(i, t.decode()) for i, t in texts.items()], "doc_id long, text string")
    got = {r[0]: tuple(r[1:]) for r in suffix.deduplicated(df).collect()}
    assert got == removed(texts)


def test_suffix_order():
    draw = np.random.default_rng(1)
    texts = [draw.integers(1, int(k) + 1, int(n)) for n, k in zip(draw.integers(0, 60, 400), draw.integers(1, 5, 400))]
    half = draw.integers(1, 2**30, 500)
    for x in [*texts, np.ones(300, np.int64), np.concatenate([half, half])]:
        assert suffix.suffix_order(x).tolist() == sorted(range(len(x)), key=lambda i: x[i:].tolist())


def test_suffix_parts_of_a_mark(spark):
    """A passage in many texts that differ around it, and a periodic text: their marks are dealt over many parts."""
    draw = np.random.default_rng(2)

    def noise(n: int) -> bytes:
        return bytes(draw.integers(97, 123, n, dtype=np.uint8))

    passage = noise(170)
    texts = {i: noise(40 + i % 7) + passage[i % 3 :] + noise(60) for i in range(200)} | {500: b"abc" * 400, 501: b"bca" * 300 + passage, 502: passage[:99]}
    df = spark.createDataFrame([(i, bytearray(t)) for i, t in texts.items()], "id long, text binary")
    ranges = {}
    for i, start, end in suffix.repeated_starts(df.where("length(text) >= 100"), places=4).collect():
        ranges.setdefault(i, set()).update(range(start, end))
    seen, expected = set(), {}
    for i in sorted(texts):
        for s in range(len(texts[i]) - 99):
            if (x := texts[i][s : s + 100]) in seen:
                expected.setdefault(i, set()).add(s)
            seen.add(x)
    assert ranges == expected


def test_suffix_edges(spark, edge):
    got = suffix.deduplicated(edge).collect()
    assert len(got) == len(EDGE) and sum(r["n_bytes"] for r in got) == sum(len((r[1] or "").encode()) for r in EDGE)
    assert {r["n_removed"] for r in got if r["doc_id"] == 5} == {len(LONG) - 49}
    assert suffix.deduplicated(edge.limit(0)).collect() == []


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = QUERIES["op3_language_id"](spark, FOLDER).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 20 and np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95 and all(0 <= r["score"] <= 1 for r in rows)


def exact_shares(learnt: list[tuple[str, str]], text: str, share: float = 0.3) -> dict[str, float]:
    """Share of the trigrams of a text in the exact set of each language."""

    def grams(t):
        framed = [" " if not c.isalpha() else c for c in f" {t.lower()} "]
        return ["".join(framed[i - 1 : i + 2]) for i in range(1, len(framed) - 1) if framed[i] != " "]

    if not hasattr(exact_shares, "sets"):
        rates = {}
        for lang in {x for x, _ in learnt}:
            found = [g for x, t in learnt if x == lang for g in grams(t)]
            for g in found:
                rates.setdefault(g, {}).setdefault(lang, 0)
                rates[g][lang] += 1 / len(found)
        exact_shares.sets = {x: {g for g, r in rates.items() if r.get(x, 0) >= share * max(r.values())} for x, _ in learnt}
    mine = grams(text)
    return {x: sum(g in s for g in mine) / len(mine) for x, s in exact_shares.sets.items()} if mine else {}


@pytest.mark.parametrize("max_cells", [1 << 22, 1 << 14])
def test_language_brute_force(spark, max_cells):
    """Filters of one part and of several parts agree with exact sets."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang", "text")
    rows = [r for r in docs.collect() if r["text"]]
    learnt = [(r["lang"], r["text"]) for r in rows if r["lang"] is not None]
    got = {r["doc_id"]: r["language"] for r in langid.predicted(docs, F.lit(True), max_cells=max_cells).collect()}
    assert len(got) == docs.count()
    for r in rows:
        want = exact_shares(learnt, r["text"])
        found = got[r["doc_id"]]
        if not want:
            assert found["lang_pred"] == "und"
            continue
        assert max(want.values()) - want[found["lang_pred"]] < 0.02 and abs(found["score"] - max(want.values())) < 0.02


def test_language_ties_and_parts(spark, edge):
    rows = [(i, x, "the same words here", 1) for i, x in enumerate(("b", "a", "c"))] + [(None, "b", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string, key long")
    for cells in (1 << 22, 1 << 12):
        got = langid.predicted(docs, F.lit(True), max_cells=cells).collect()
        assert sorted(r["language"]["lang_pred"] for r in got) == ["a", "a", "a", "und"] and {r["key"] for r in got} == {1}
    many = spark.createDataFrame([(i, f"l{i % 70:02}", "".join(chr(97 + (i * 7 + j * j) % 26) for j in range(200))) for i in range(140)], "doc_id long, lang string, text string")
    parts = list(langid.learn(many.select("lang", "text"), max_cells=1 << 13))
    assert len(parts) > 1 and parts[0].cells.shape == (1 << 12, 2) and [p.part for p in parts] == list(range(parts[0].parts))
    whole = {r["doc_id"]: r["language"] for r in langid.predicted(many, F.lit(True)).collect()}
    for r in langid.predicted(many, F.lit(True), max_cells=1 << 13).collect():
        assert abs(r["language"]["score"] - whole[r["doc_id"]]["score"]) < 0.02


def test_language_writes_no_files(spark, edge):
    before = shared_files(spark)
    held = set(spark.sparkContext._jsc.getPersistentRDDs().keySet())
    assert len(langid.predicted(edge, F.lit(True)).collect()) == len(EDGE)
    assert shared_files(spark) == before and set(spark.sparkContext._jsc.getPersistentRDDs().keySet()) == held


def test_language_edges(spark, edge):
    got = {r["doc_id"]: r["language"] for r in langid.predicted(edge, F.lit(True)).collect()}
    assert got[2]["lang_pred"] == got[3]["lang_pred"] == got[7]["lang_pred"] == "und" and got[1]["lang_pred"] == "en"
    nothing = langid.predicted(edge, F.lit(False)).collect()
    assert {r["language"]["lang_pred"] for r in nothing} == {"und"}
    assert langid.predicted(edge.limit(0), F.lit(True)).collect() == []


def test_filters_hold_every_language_of_a_trigram():
    grams = langid.trigrams("The Cat")
    assert len(grams) == 6 and (langid.trigrams("the, cat!") == grams).all()


def test_top_k_edges(spark):
    rows = [(0, [1.0, 0.5]), (1, [1.0]), (2, [1.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, []), (100, [1e300, -1e300]), (None, [1.0, 1.0]), (7, [-0.0001, 2.0])]
    got = topk.top_k(spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score long"), k=3).collect()
    mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == 0)
    assert mine == [(1, 100, 2**63 - 1), (2, 1, 1024 * 1024), (3, 2, 1024 * 1024)]
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_top_k_ties_and_few(spark):
    rows = [(i, [1.0, 0.0]) for i in range(200)] + [(500 + i, [2.0, float(i)]) for i in range(4)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=6, block_bytes=1).collect()
    best = [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == 100), key=lambda r: r["rank"])]
    assert best == [500, 501, 502, 503, 0, 1]


def test_top_k_repeated_ids(spark):
    rows = [(0, [1.0]), (0, [1.0, 2.0]), (0, [1.0, 3.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0]), (8, None)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=5).collect()
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == 0) == [(1, 7, 4 << 20), (2, 7, 4 << 20)]


def test_top_k_brute_force_in_blocks(spark):
    rng = np.random.default_rng(11)
    vectors = np.concatenate([rng.integers(-3, 4, (500, 5)) / 2, np.repeat(rng.integers(-3, 4, (1, 5)) / 2, 200, 0)])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(7)
    whole = np.floor(vectors * 1024).astype(np.int64)
    for size in (64 << 20, 60_000):
        got = {}
        for r in topk.top_k(frame, every=50, k=12, block_bytes=size).collect():
            got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
        for q in range(0, 700, 50):
            score = whole @ whole[q]
            order = [i for i in np.lexsort((np.arange(700), -score)) if i != q][:12]
            assert sorted(got[q]) == [(n + 1, i, score[i]) for n, i in enumerate(order)]


def test_html():
    page = (
        "<html><head><title>T</title></head><body class='has-sidebar'><nav><a href='/'>Home</a></nav><div class=\"ad\">Buy</div><article><h1>A &amp; B</h1>"
        "<p>One<b>two</b><br>three &eacute;&#233;<p>Four<script>var t='</p>';</script><!-- c --> five <aside>no</aside><form>no</form>"
        "<div class='comments'><p>me too</div><p title='a > b'>six</article><footer>&copy; x</footer></body></html>"
    )
    assert html.main_text(page) == "A & B Onetwo three éé Four five six"
    assert html.main_text("") == "" and html.main_text("<!-- open") == "" and html.main_text("<p") == ""
    good = "It is the first of the pages that we have to read and it is long enough for the rules to see that this is a text. " * 3
    assert html.main_text(f"<div><p>{good}</p><p>and short</p><p>{good}</p></div><div><a href='x'>Other links of the page</a></div>") == " ".join(f"{good} and short {good}".split())


PROSE = "It is the first of the pages that we have to read and it is long enough for the rules to see that this is a text. " * 3


def test_html_marks_are_votes():
    good = PROSE.strip()
    teaser = "<article class='card'><h3><a href='x'>Next</a></h3><p>A short teaser</p></article>"
    assert html.main_text(f"<div><p>{good}</p><p>and short</p><p>{good}</p></div>{teaser}") == f"{good} and short {good}"
    links = "<ul><li><a href='a'>Home</a><li><a href='b'>All of the other news of this day</a></ul>"
    assert html.main_text(f"<main>{links}<p>Share this</p>{links}<h1>Title</h1><p>{good}</p><p>{good}</p>{links}<p>Terms apply</p></main>") == f"Title {good} {good}"
    assert html.main_text("<main><h1>Few</h1><p>words</p></main>") == "Few words"


def test_html_names_are_votes():
    good = PROSE.strip()
    for wrapper in ("div class='content sidebar-right'", "div id='layout-with-sidebar'", "div class=widget", "article class='post comments-open'"):
        assert html.main_text(f"<{wrapper}><p>{good}</p><div class=sidebar><p>Other things</p></div></{wrapper.split()[0]}>") == good
    page = f"<article><p>{good}</p><section id='related-work'><h2 id='search'>Search</h2><p>{good}</p></section><div class=related>{good}</div><p>{good}</p></article>"
    assert html.main_text(page) == f"{good} Search {good} {good}"
    page = f"<div><p>{good}</p><p>{good}</p><p>{good}</p></div><div class='{{}}'><p>{good}</p></div>"
    assert html.main_text(page.format("text share-your-view")) == " ".join([good] * 4) and html.main_text(page.format("comments")) == " ".join([good] * 3)


def test_html_few_stop_words():
    good = PROSE.strip()
    links = "<ul><li><a href='a'>Home</a><li><a href='b'>All of the other news</a></ul>"
    numbers = "Berlin 3,755,251; Hamburg 1,892,122; München 1,512,491; Köln 1,084,831; Frankfurt 773,068; Stuttgart 632,865; Leipzig 616,093."
    assert html.main_text(f"{links}<div><p>{good}</p><p>{numbers}</p><p>{good}</p></div>{links}<p>{numbers}</p>{links}") == f"{good} {numbers} {good}"
    portuguese = "O livro que ela leu na escola não era o mais novo, mas foi com ele que os alunos da turma viram como se faz uma boa história para todos. " * 2
    finnish = "Vanha kirjasto avattiin uudelleen keväällä, jolloin kaupungin asukkaat kokoontuivat katsomaan korjattua rakennusta ja kuuntelemaan musiikkia. " * 2
    chinese = "这座城市的图书馆在春天重新开放，许多居民前来参观修复后的建筑，并聆听了当地乐团的演奏。人们在阅览室里谈论书籍，孩子们在院子里玩耍，直到傍晚才慢慢离开。"
    for text in (portuguese, finnish, chinese):
        assert html.main_text(f"{links}<div><p>{text}</p><p>{text}</p></div>{links}") == " ".join([text.strip()] * 2)
    quote = "It is the first of the pages that we have to read, and it is long enough for this."
    assert html.main_text(f"<div><p>{finnish}</p><p>{quote}</p><p>{finnish}</p></div>") == f"{finnish.strip()} {quote} {finnish.strip()}"


def test_html_hidden_is_an_attribute():
    good = PROSE.strip()
    for tag in ("section title='The hidden cost of paper'", "section data-x=hidden", "section class='hidden md:block'", "section aria-hidden=false", "section style='color: none'"):
        assert html.main_text(f"<article><{tag}><p>{good}</p></section></article>") == good
    for tag in ("p hidden", "p HIDDEN=''", "p style='margin:0; display : none'", "p style='visibility:hidden'"):
        assert html.main_text(f"<article><p>{good}</p><{tag}>{good}</p></article>") == good
    assert html.main_text(f"<div class='hidden md:block'><p>{good}</p></div>") == good


def test_html_forms_are_votes():
    good = PROSE.strip()
    assert html.main_text(f"<form id=aspnetForm><div><p>{good}</p><p>and short</p><p>{good}</p></div><form><p>Your mail</p></form></form>") == f"{good} and short {good}"
    assert html.main_text(f"<p>{good}</p><p>{good}</p><form><label>Write to us</label><p>{good[:100]}</p></form>") == f"{good} {good}"


def test_html_lists_close_items():
    good = PROSE.strip()
    assert html.main_text(f"<p>{good}</p><ul><li class=ad><p>Buy<li><p>{good}</ul><p>{good}</p>") == " ".join([good] * 3)


def test_html_deep_and_long_pages():
    """A hundred thousand open tags of any kind take seconds, not hours."""
    n, good = 100_000, PROSE.strip()
    for tags in ("<b>" * n + "</div>" * n, "<div>" * n + "<tr></tr></b>" * n, "<div class=ad><p>x" * n, "<ul><li><p>" * n, "<b><div>" + "<i>" * n + "</b>" * n):
        began = time.process_time()
        assert good in html.main_text(f"<div><p>{good}</p><p>{good}</p></div>{tags}")
        assert time.process_time() - began < 20
    assert html.main_text(f"<div><p>{good * 3000}</p></div>") == " ".join((good * 3000).split())


def test_html_edges(spark):
    df = spark.createDataFrame([(1, "u", None, 3), (None, None, "<article>a  b</article>", 3), (1, "u", "", 3)], "page_id long, url string, html string, text long")
    assert {(r["page_id"], r["url"], r["n_chars"]) for r in html.extracted(df).collect()} == {(1, "u", 0), (None, None, 3)}
    assert sorted(r["text"] for r in html.extracted(df).collect()) == ["", "", "a b"]
    assert html.extracted(df.limit(0)).collect() == []


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "%7C <|im_end|>\n\\ %25"), (1, 1, "assistant", "a<"), (1, 2, "ro\nle", None), (2, None, None, "only"), (None, 1, "assistant", ""), (3, 1, "assistant", "x"), (3, 1, "assistant", "x")]
    made = chat.examples(spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, example long"))
    got = {r["conv_id"]: r for r in chat.conversation_digests(made).collect()}
    said = "user\n%7C <|im_end|>\n\\ %25\nassistant\na<\nro\nle\n\n"
    assert got[1]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest() and got[1]["n_turns"] == 3 and got[1]["loss_chars"] == 2
    assert got[3]["loss_sha256"] == hashlib.sha256(b"xx").hexdigest() and got[2]["loss_chars"] == 0 and got[None]["n_turns"] == 1
    assert made.limit(0).count() == 0
    for r in made.where("loss_chars > 0").collect():
        assert r["formatted"][r["loss_start"] + r["loss_chars"] :] == "<|im_end|>\n"


def test_pieces_brute_force(spark, edge):
    vocabulary = pieces.Vocabulary(MODEL_FILE)
    encoder = pieces.Encoder(vocabulary)
    score = {p: s for p, _, s in vocabulary.normal}
    name = {i: p for p, i, _ in vocabulary.normal}

    def best(word):
        sums = [0.0] + [float("-inf")] * len(word)
        for end in range(1, len(word) + 1):
            sums[end] = max([sums[end - 1] + encoder.fallback] + [sums[s] + score[word[s:end]] for s in range(end) if word[s:end] in score])
        return sums[-1]

    for word in ("▁there", "▁▁international", "▁中éz", "aaaaaaaaaaaab", "▁Verantwortung", "\u0007▁"):
        ids = encoder.segment(word)
        spelt = sum(len(c.encode()) for c in "".join(name.get(i, "") for i in ids))
        sums = sum(score[name[i]] for i in ids if i in name)
        rest = word.encode()[spelt:] if spelt < len(word.encode()) else b""
        unknown = len(word) - sum(len(name[i]) for i in ids if i in name)
        assert sums + unknown * encoder.fallback == pytest.approx(best(word)), rest
    for text in ("", " ", "a b  c", "▁", " ▁▁ x", "\U0001F600\n\tq", "<0x41> </s>"):
        assert encoder.decode(encoder.encode(text)).decode() == text
    # Whole texts, scored as one string; the words of a text are met again after the cache has turned over.
    tiny = pieces.Encoder(vocabulary, max_words=2)
    for text in ("the best  way to say it is the way", "Verantwortung zé中 für x\n\ty the the", "a " * 60 + "  b"):
        ids = encoder.encode(text)
        assert tiny.encode(text) == ids and tiny.both(text)[1].decode() == text
        known = sum(len(name[i]) for i in ids if i in name)
        marked = "▁" + text.replace(" ", "▁")
        total = sum(score[name[i]] for i in ids if i in name) + (len(marked) - known) * encoder.fallback
        assert total == pytest.approx(best(marked))
    rows = pieces.encoded(edge, MODEL_FILE).collect()
    assert len(rows) == len(EDGE) and all(r["exact"] for r in rows) and [r["n_tokens"] for r in rows if r["doc_id"] == 2] == [0]
    assert pieces.encoded(edge.limit(0), MODEL_FILE).collect() == []


def test_mixing(spark, edge):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    n = {r["source"]: r["tokens"] for r in mixing.source_tokens(docs).collect()}
    words = {}
    for r in docs.collect():
        words[r["source"]] = words.get(r["source"], 0) + len(SPACES.sub(" ", r["text"]).split())
    assert n == words
    exponent = mixing.find_exponent(mixing.source_tokens(docs), repetition=1.5)
    most, least = max(n.values()), min(n.values())
    assert (most / least) ** (1 - exponent) == pytest.approx(1.5, rel=1e-6)
    weight = {s: (t / sum(n.values())) ** exponent for s, t in n.items()}
    total = sum(weight.values())
    budget = max(t / weight[s] for s, t in n.items()) * total
    out = mixing.mixture(docs, repetition=1.5).collect()
    drawn, ids = {}, {}
    for r in out:
        drawn[r["source"]] = drawn.get(r["source"], 0) + r["mix"]["n_tokens"]
        ids.setdefault((r["source"], r["mix"]["epoch"]), []).append(r["doc_id"])
    longest = {}
    for r in docs.collect():
        longest[r["source"]] = max(longest.get(r["source"], 0), len(r["text"].split()))
    for s in n:
        want = weight[s] / total * budget
        assert want - longest[s] - 1 <= drawn[s] <= want + 1
        assert len(set(ids[s, 0])) == len(ids[s, 0]) == docs.where(F.col("source") == s).count()
    flat = mixing.find_exponent(mixing.source_tokens(docs), entropy=0.999)
    assert 0 <= flat <= 1
    small = mixing.mixture(docs, repetition=None, entropy=0.0, budget=sum(n.values()) / 4).collect()
    assert sum(r["mix"]["n_tokens"] for r in small) <= sum(n.values()) / 4 + len(n)
    rows = mixing.mixture(edge).collect()
    assert {r["doc_id"] for r in rows} == {r[0] for r in EDGE} and mixing.mixture(edge.limit(0)).collect() == []


def test_quality(spark, edge, db):
    rows = QUERIES["op1_quality_classifier"](spark, FOLDER).collect()
    label = dict((i, q == 1 and t == 0) for i, q, t in db.execute("SELECT * FROM labels").fetchall())
    known = [(label[r["doc_id"]], r["kept"]) for r in rows if r["doc_id"] in label]
    assert len(rows) == db.execute("SELECT count(*) FROM documents").fetchone()[0] and np.mean([a == b for a, b in known]) > 0.9
    none = spark.createDataFrame([(1, None), (None, 2), (2, 9)], "id long, grade int")
    assert all(r["quality"]["kept"] and r["quality"]["tail"] is None for r in quality.quality_grades(edge, none).collect())
    one = spark.createDataFrame([(1, 2), (3, 0), (1, 1)], "id long, grade int")
    assert len(quality.quality_grades(edge, one).collect()) == len(EDGE) and quality.quality_grades(edge.limit(0), one).collect() == []


def test_quality_fit_orders_grades():
    rng = np.random.default_rng(0)
    grades = rng.integers(0, 3, 600)
    rows = [np.unique(np.concatenate([rng.integers(100, 200, 20), [g, 50 + (g > 0)]])).astype(np.int32) for g in grades]
    model = quality.fit(rows, grades, 3, 300, 1e-4, 5)
    assert model.thresholds[0] < model.thresholds[1]
    assert np.mean([int((model.tails(r) > 0.5).sum()) == g for r, g in zip(rows, grades)]) > 0.95


def test_shingles_follow_words():
    a, b = (textbytes.shingles(np.frombuffer(x, np.uint8), 3) for x in (b"The cat\tsat  down", b"the CAT sat\x0bdown"))
    assert len(a) == 2 and (a == b).all() and len(textbytes.shingles(np.frombuffer(b"a b", np.uint8), 3)) == 1


def test_pipeline_dedup_by_row(spark):
    import corpus_pipeline

    rows = [(3, "A"), (5, "A"), (5, "unique text"), (7, "equal rows"), (7, "equal rows"), (None, "A"), (None, "no id"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {(3, "A"), (5, "unique text"), (7, "equal rows"), (None, "no id")}
    for stage in (corpus_pipeline.exact_dedup, corpus_pipeline.minhash_dedup):
        got = [tuple(r) for r in stage(spark, docs, FOLDER).collect()]
        assert len(got) == 4 and set(got) == want
    assert {tuple(r) for r in corpus_pipeline.exact_dedup(spark, docs.where("doc_id is not null").limit(2), FOLDER).collect()} == {(3, "A")}


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    quality_kept = corpus_pipeline.quality_classifier(spark, docs, FOLDER)
    assert quality_kept.columns == docs.columns
    single = corpus_pipeline.exact_dedup(spark, docs, FOLDER)
    assert single.count() == len({SPACES.sub(" ", r["text"]) for r in docs.collect()})
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.where("exact").count() == out.count() > 0
