import hashlib
import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import tables
from tradewind.llm import (
    components,
    cotraining,
    decontaminate,
    html_extract,
    queries,
    simhash,
    suffix_array,
    suffix_dedup,
    text,
)

# --- suffix arrays -----------------------------------------------------------------------------


def test_suffix_array_and_common_prefixes():
    rng = random.Random(2)
    for t in range(150):
        raw = bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 150)))
        raw = raw[:30] * 5 if t % 3 == 0 else raw
        data = np.frombuffer(raw, np.uint8)
        order = suffix_array.suffix_array(data)
        assert order.tolist() == sorted(range(len(raw)), key=lambda i, raw=raw: raw[i:])
        shared = suffix_array.common_prefixes(data, order, 20)
        for k in range(1, len(raw)):
            a, b = raw[order[k - 1]:], raw[order[k]:]
            n = next((j for j in range(min(len(a), len(b), 20)) if a[j] != b[j]), min(len(a), len(b), 20))
            assert shared[k] == n


def brute_repeats(rows, length):
    """Kept bytes and spans by looking every window up among all earlier ones."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, rows[k][2]))
    seen, out = set(), []
    for k in order:
        data = (rows[k][1] or "").encode()
        gone = [False] * len(data)
        for s in range(len(data) - length + 1):
            window = data[s:s + length]
            if window in seen:
                gone[s:s + length] = [True] * length
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = len(re.findall("1+", "".join("01"[g] for g in gone)))
        out.append((str(rows[k][0]), len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("hot", [1024, 2])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 8000)
    rows = tables.awkward()
    base = tables.prose(7, 120)
    rows += [(100 + k, tables.prose(900 + k, 20) + base[40:400] + tables.prose(950 + k, 20), "en", "s", 1) for k in range(12)]
    rows += [(200, "ab" * 400, "en", "s", 1), (201, "x" * 99, "en", "s", 1), (202, "x" * 100, "en", "s", 1), (203, "x" * 300, "en", "s", 1)]
    df = tables.frame(spark, rows)
    hashes = {r.text: r.h for r in df.select("text", F.xxhash64("text").alias("h")).distinct().collect()}
    got = suffix_dedup.remove_repeats(df).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest())
                  for r in got) == brute_repeats([(r[0], r[1], hashes[r[1]]) for r in rows], 100)
    for r in got:
        assert sum(s.end - s.start for s in r.spans) == r.n_bytes - len(r.kept)


def test_suffix_dedup_query_writes_few_files(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 2000)
    base = tables.prose(7, 120)
    rows = [(k, tables.prose(900 + k, 20) + base[k:k + 300] + tables.prose(950 + k, 20), "en", "s", 1) for k in range(70)]
    tables.frame(spark, rows, clashing=False).write.parquet(str(tmp_path / "documents.parquet"))
    for limit, files in ((None, 1), (30, 3)):
        if limit:
            monkeypatch.setattr(queries, "ROWS_A_FILE", limit)
        queries.op2_suffix_dedup(spark, str(tmp_path)).write.parquet(str(tmp_path / f"out{files}"))
        assert len(list((tmp_path / f"out{files}").glob("part-*"))) == files
        got = spark.read.parquet(str(tmp_path / f"out{files}")).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_repeats(
            [(r[0], r[1], 0) for r in rows], 100)


def test_suffix_dedup_deals_shards_evenly(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 2000)
    df = tables.frame(spark, [(k, tables.prose(k, 40), "en", "s", 1) for k in range(150)])
    shards = df.agg(F.sum(F.octet_length("text"))).first()[0] // 2000 + 1
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.select("doc_id", F.pmod(F.xxhash64(F.xxhash64("text"), "doc_id"), F.lit(shards)).alias("s"))
    dealt = suffix_dedup.remove_repeats(df).select("doc_id", F.spark_partition_id().alias("task")).join(keyed, "doc_id")
    held = [r.n for r in dealt.groupBy("task").agg(F.countDistinct("s").alias("n")).collect()]
    assert keyed.select("s").distinct().count() == shards > 2 * tasks
    assert len(held) == tasks and max(held) - min(held) <= 1


# --- SimHash -----------------------------------------------------------------------------------


def brute_fingerprint(value):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), value or ""))
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(items, linked):
    name = list(range(len(items)))
    for i, j in combinations(range(len(items)), 2):
        if linked(items[i], items[j]):
            a, b = name[i], name[j]
            name = [min(a, b) if n in (a, b) else n for n in name]
    return name


def test_near_duplicates_equal_brute_force(spark):
    rows = tables.awkward()
    df = tables.frame(spark, rows)
    fps = [brute_fingerprint(r[1]) for r in rows]
    name = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for n, r in zip(name, rows, strict=True):
        if r[0] is not None:
            least[n] = min(least.get(n, r[0]), r[0])
    got = simhash.near_duplicates(df).collect()
    assert sorted((str(r.doc_id), r.fp % (1 << 64), r.component_id) for r in got) == sorted(
        (str(r[0]), f, least.get(n)) for r, f, n in zip(rows, fps, name, strict=True))
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns and kept.exceptAll(df).count() == 0
    kept_fps = [brute_fingerprint(r.text) for r in kept.collect()]
    assert len(kept_fps) == len(set(name))
    assert {name[fps.index(f)] for f in kept_fps} == set(name)


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_ball_links_connect_what_is_near(spark, radius):
    rng = random.Random(radius)
    fps = {rng.getrandbits(64) for _ in range(6)}
    for _ in range(3):
        fps |= {f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, radius + 1))) for f in list(fps)}
    fps = sorted(fps)[:60 if radius == 4 else 200]
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = simhash.link_buckets(spark.createDataFrame(signed, "fp long"), radius, 5).distinct().collect()
    near = {(a, b) for a, b in combinations(fps, 2) if (a ^ b).bit_count() <= radius}
    found = {tuple(sorted((r.a % (1 << 64), r.b % (1 << 64)))) for r in links}
    assert found <= near
    assert brute_components(fps, lambda a, b: tuple(sorted((a, b))) in found) == brute_components(
        fps, lambda a, b: (a ^ b).bit_count() <= radius)


def test_components_of_chains_hubs_and_nothing(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 50)] + [(7, 7), (300, 299), (299, 300)]
    got = {r.a: r.b for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: 0 for k in range(1, 41)} | {100 + k: 100 for k in range(1, 50)} | {300: 299}
    assert got == want
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- decontamination ---------------------------------------------------------------------------


def brute_leaks(rows, items):
    def words(value):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), value or ""))

    def shingles(w, size):
        return Counter(tuple(w[k:k + size]) for k in range(len(w) - size + 1))

    out = set()
    for doc, value, *_ in rows:
        w = words(value)
        for item, item_text in items:
            i = words(item_text)
            if not i or not w:
                continue
            size, n = min(5, len(i)), min(len(i), len(w))
            want = shingles(i, size)
            for at in range(len(w) - n + 1):
                have = shingles(w[at:at + n], size)
                shared = (have & want).total()
                if shared / ((have | want).total() or 1) >= 0.8:
                    out.add((doc, item))
                    break
    return out


def test_decontamination_equals_brute_force(spark):
    rows = tables.awkward()
    items = [(k, tables.prose(3000 + k, 12 + 5 * k)) for k in range(6)] + [(10, "two words"), (11, None), (12, ""), (13, tables.prose(7, 30))]
    for k, (_, t) in enumerate(items[:6]):
        w = t.split()
        w[len(w) // 2] = w[len(w) // 2] if k % 2 else "changed"
        rows.append((500 + k, tables.prose(k, 40) + " " + " ".join(w).upper() + "; " + tables.prose(50 + k, 40), "en", "s", 1))
        rows.append((600 + k, tables.prose(k, 40) + " " + " ".join(t.split()[: len(t.split()) // 2]), "en", "s", 1))
    rows += [(700, "some two words here", "en", "s", 1), (701, items[3][1], "en", "s", 1), (702, items[5][1][:-20], "en", "s", 1)]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("x"))
    df = tables.frame(spark, rows)
    got = decontaminate.find_leaks(df, benchmark)
    want = brute_leaks(rows, items)
    found = got.collect()
    assert {(r.doc_id, r.item_id) for r in found} == want and len(found) == len(want)
    assert all(0.8 <= r.similarity <= 1 for r in found)
    clean = decontaminate.keep_clean(df, benchmark)
    assert clean.columns == df.columns  # each row by its own text, also where ids are equal or null
    assert sorted((str(r.doc_id), str(r.text)) for r in clean.collect()) == sorted(
        (str(r[0]), str(r[1])) for r in rows if not brute_leaks([r], items))


def test_decontamination_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 200)
    items = [(k, tables.prose(3000 + k, 20)) for k in range(8)]
    rows = [(k, tables.prose(k, 30) + " " + items[k][1], "en", "s", 1) for k in range(8)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_leaks(tables.frame(spark, rows), benchmark)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(k, k) for k in range(8)}
    assert decontaminate.keep_clean(tables.frame(spark, rows), benchmark).count() == 0


def test_index_lists_every_fingerprint_within_the_radius():
    rng = random.Random(5)
    group = decontaminate.SizeGroup([(k, np.array([rng.getrandbits(64) for _ in range(9)], np.uint64)) for k in range(20)])
    for k, fp in enumerate(group.fps.tolist()):
        near = [fp ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, decontaminate.RADIUS))) for _ in range(50)]
        window, item = group.candidates(np.array(near, np.uint64))
        assert set(window[item == k].tolist()) == set(range(50))


# --- main text ---------------------------------------------------------------------------------

PAGE = """<html><head><title>T</title></head><body><header class="site"><h1>Site</h1><a href=/>Home</a></header><nav><a>x</a></nav>
<div id="wrap"><div class="sidebar"><p>Lots of side text, with commas, and more. Indeed.</p></div><div class="post"><h2>Head</h2>
<p>First para with <a href=x>a link</a>, some text. And more, of it.</p><p>Short.</p><ul><li>one<li>two, with text.</ul>
<p>Last para &eacute;&nbsp;is here, with words and more words; fine.<div class="ad">Buy now!</div></div><div class="comments"><p>I think
this is great, really great, and so long a comment. Yes, it is. It really is.</p></div><form><p>Email, please. Now.</p></form></div>
<footer>c 2020</footer><script>x<p></script></body></html>"""


def test_main_text_of_a_page():
    assert html_extract.extract(PAGE).split("\n\n") == [
        "Head", "First para with a link, some text. And more, of it.", "Short.", "one", "two, with text.",
        "Last para é is here, with words and more words; fine."]
    unclosed = "<article><h1>Title</h1><p><b>Bold, it is.<br><p>Next &amp;&amp; more, yes.</article><footer>x, y. z</footer>"
    assert html_extract.extract(unclosed) == "Title\n\nBold, it is.\n\nNext && more, yes."
    assert html_extract.extract("<article><p>Text, and more.</p><article class=comment><p>No, not this.</p></article></article>") == "Text, and more."


ARTICLE = "<article><h1>Head</h1><p>First para, with some text. And more, of it.</p><p>Second para, as long. Yes, it is.</p></article>"
ARTICLE_TEXT = "Head\n\nFirst para, with some text. And more, of it.\n\nSecond para, as long. Yes, it is."


@pytest.mark.parametrize("open_tag", [
    "<div class='content no-sidebar'>", "<div class='layout-with-sidebar'>", "<div id=has-comments>", "<div class=social-news>",
    "<div class='sidebar'>", "<div class='wrap related'>", "<div role=search>", "<form>", "<div class=comments>"])
def test_a_name_does_not_silence_the_article(open_tag):
    page = f"<body><nav><a href=/>Home</a></nav>{open_tag}{{}}</{open_tag[1:].split()[0].rstrip('>')}><div class=ad>Buy, now. Now!</div></body>"
    assert html_extract.extract(page.format(ARTICLE)) == ARTICLE_TEXT
    # most of the text, without an article
    assert html_extract.extract(page.format(ARTICLE[9:-10])) == ARTICLE_TEXT


def test_names_still_silence_what_is_around_the_article():
    for part in ("<div class=comments><article class=comment-body><p>I think, so. Yes, it is great.</p></article></div>",
                 "<div class=comments><article><p>I think, so. Yes, it is great, really so.</p></article></div>",
                 "<div id=sidebar><p>Side text, and more. Indeed.</p></div>", "<form><p>Email, please. Now.</p></form>"):
        assert html_extract.extract(f"<body>{ARTICLE}{part}</body>") == ARTICLE_TEXT
    inline = "<article><p>Text, and more of it.<span class=ad> Buy!</span> Then the end, of it.</p></article>"
    assert html_extract.extract(inline) == "Text, and more of it. Then the end, of it."


def test_ratios_decide_inside_an_article():
    links = "<ul>" + "".join(f"<li><a href=/{k}>See also this page number {k}</a></li>" for k in range(9)) + "</ul>"
    assert html_extract.extract(f"<main>{ARTICLE[9:-10]}{links}</main>") == ARTICLE_TEXT


def test_pages_keep_all_rows(spark):
    deep = "<div>" * 3000 + "deep, text." + "</div>" * 3000
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (3, "u", ""), (None, "v", "<"), (4, "w", "plain, text."), (5, "w", deep),
            (6, "w", "<p>" + "word, " * 50000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("z"))
    got = html_extract.extract_main_text(df).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by_id = {r.page_id: r.text for r in got}
    assert by_id[2] == by_id[3] == "" and by_id[4] == "plain, text." and by_id[5] == "deep, text."
    assert by_id[6] == ("word, " * 50000).strip()
    assert html_extract.extract_main_text(df.limit(0)).count() == 0


# --- co-training -------------------------------------------------------------------------------


def corpus(n):
    """Good prose, and shouting or marked-up junk from another source."""
    rows, labels = [], []
    for k in range(n):
        bad = k % 5 == 0
        t = tables.prose(k, 50)
        t = (t.upper().replace(" ", "!! ") if k % 2 else t.replace(" ", " | ")) if bad else t
        rows.append((k, t, "en", "junk" if bad and k % 3 else "src", len(t)))
        labels.append((k, int(not bad)))
    return rows, labels


def test_classifier_on_held_out_documents(spark):
    rows, labels = corpus(900)
    df = tables.frame(spark, rows)
    known = spark.createDataFrame([x for x in labels if x[0] < 500] + [(None, 1), (3, None)], "doc_id long, quality int")
    model = cotraining.fit(df, known)
    got = {r.doc_id: r for r in cotraining.score(df, model).collect()}
    truth = dict(labels)
    right = sum(got[k].kept == bool(truth[k]) for k in range(500, 900))
    assert len(got) == 900 and right >= 0.97 * 400
    kept = cotraining.keep_good(df, model)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {k for k, r in got.items() if r.kept}


def test_views_choose_among_all_documents(spark):
    rows, labels = corpus(600)
    df = tables.frame(spark, rows + [(None, "x", None, None, 1)] + [(9000 + k, rows[0][1], "en", "junk", 1) for k in range(200)])
    known = spark.createDataFrame([x for x in labels if x[0] % 4 == 0], "doc_id long, quality int")
    narrow = cotraining._narrow(df, "doc_id", "text", "source", "lang")
    features = cotraining.features_of(narrow.join(known, "doc_id").select(*narrow.columns, "quality"))
    state = cotraining.CoTraining(features)
    models = state.fit_views()
    chosen = cotraining.surest(narrow, known, models, 7, 5).to_pylist()
    margins = {}
    for doc, body, lang, source, _ in rows:
        if doc % 4:
            data, offsets = text.flat(pa.array([body]))
            margins[doc] = (cotraining.content_margin(data, offsets, models[0].weights)[0] + models[0].bias,
                            models[1].margin(cotraining.metadata_matrix(data, offsets, [source], [lang]))[0])
    for view in (0, 1):
        mine = {c["doc_id"] for c in chosen if c["view"] == view and c["label"] == 1}
        assert len(mine) <= 7 and all(margins[d][view] >= 2.94 for d in mine)
        if len(mine) == 7:
            worst = min(margins[d][view] for d in mine)
            better = {m for d, m in margins.items() if m[view] > worst + 1e-9}
            assert len(better) < 7
    assert sum(c["doc_id"] >= 9000 for c in chosen) == 0 or len([c for c in chosen if c["doc_id"] >= 9000]) <= 2  # copies stand for one
    state.learn(cotraining.surest(narrow, known, models, 7, 5), cotraining.features_of(
        narrow.where("doc_id % 4 = 1").limit(3).selectExpr("*", "-1 AS quality")))
    assert len(state.ids) == len(features) + 3 == len(state.views[0]) == len(state.labels[1])


def test_margins_equal_the_matrix():
    data, offsets = text.flat(pa.array(["", "ab", "hello there, World 12", None, "é" * 50]))
    weights = np.random.default_rng(0).normal(size=cotraining.RAW + cotraining.SHAPE)
    assert np.allclose(cotraining.content_matrix(data, offsets) @ weights, cotraining.content_margin(data, offsets, weights), atol=1e-5)


def test_classifier_without_labels_keeps_all(spark):
    df = tables.frame(spark, tables.awkward())
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(k, 1) for k in range(9)], "doc_id long, quality int")
    for labels in (none, one):
        model = cotraining.fit(df, labels)
        assert model is None
        assert cotraining.score(df, model).where("kept and score is null").count() == df.count()
    assert cotraining.keep_good(df, None).count() == df.count()


def test_cutoff_limits_false_rejections():
    good, bad = np.linspace(0.4, 1, 200), np.linspace(0, 0.6, 50)
    cut = cotraining.best_cutoff(good, bad, 0.01)
    assert (good < cut).mean() <= 0.01 and (bad < cut).any()


# --- empty tables and the pipeline -------------------------------------------------------------


def test_empty_tables(spark):
    docs = tables.empty(spark)
    benchmark = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for df in (suffix_dedup.remove_repeats(docs), simhash.near_duplicates(docs), simhash.keep_one(docs),
               decontaminate.find_leaks(docs, benchmark), decontaminate.keep_clean(docs, benchmark),
               cotraining.score(docs, cotraining.fit(docs, labels))):
        assert df.count() == 0
    assert decontaminate.keep_clean(tables.frame(spark, tables.awkward()), benchmark).count() == len(tables.awkward())


def test_pipeline_stages_take_effect(spark, tmp_path):
    rows, labels = corpus(400)
    item = tables.prose(4000, 40)
    rows += [(1000, rows[1][1], "en", "src", 1), (1001, tables.prose(2000, 30) + " " + item, "en", "src", 1),
             (1002, tables.prose(2001, 60) + " token=abcdefgh", "en", "src", 1), (1003, None, "en", "src", None)]
    tables.frame(spark, rows, False).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, columns = spark.read.parquet(f"{tmp_path}/documents.parquet"), None
    seen = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        columns = docs.columns
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/out{k}")
        docs = spark.read.parquet(f"{tmp_path}/out{k}")
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    bad = {k for k, q in labels if not q}
    assert len(seen[0] & bad) <= 0.05 * len(bad) and len(seen[0] - bad) >= 0.97 * 324
    assert 1000 in seen[0] and 1000 not in seen[1] and 1 in seen[1]
    assert 1001 in seen[1] and 1001 not in seen[2] and seen[1] - seen[2] == {1001}
    assert seen[3] == seen[2] and seen[4] == seen[3]
    redacted = spark.read.parquet(f"{tmp_path}/out3").where("doc_id = 1002").first()
    assert redacted.text.endswith(" [SECRET]") and redacted.n_chars == len(redacted.text)
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert whole.select("doc_id", "start", "length", "ids").exceptAll(docs.select("doc_id", "start", "length", "ids")).count() == 0
    assert public_tokenizers.path(corpus_pipeline.TOKENIZER)
