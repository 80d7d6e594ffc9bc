"""Corpus operators against brute force, on planted cases and on the small tables."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tallyferry.llm import (
    bpe_automaton, html_text, line_dedup, mixing, ngram_join, order_minhash, quality_rank, quality_rules, token_files,
    toxicity,
)
from tallyferry.llm.queries import QUERIES, tokenizer_path
from tallyferry.session import materialise, scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [
    (1, None, "a", "x"), (2, "", "a", "x"), (3, "one", None, "x"), (3, "one", None, "x"), (None, "no id here", "b", "x"),
    (None, None, None, None), (4, " \t\n\x0b", "b", "x"), (5, "same words in a row " * 40, "b", "x"),
    (6, "same words in a row " * 40, "c", "x"), (7, "é" * 50_000 + " ü\n" + "long " * 30_000, "c", "x"),
]
SCHEMA = "doc_id long, text string, source string, score string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, a clashing extra column."""
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(table):
    return [(r.doc_id, r.text) for r in table("documents").orderBy("doc_id").collect()]


@pytest.fixture(scope="module")
def labels(table):
    return table("labels")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_main_text_leaves_furniture_out(spark):
    page = (
        "<html><head><title>T</title><script>var a='</p>';</script></head><body class=home><nav><a href=/>Home</a></nav>"
        "<header><p>Header, of the site, with commas, and more words than it needs</p></header>"
        "<div id=content><h1>Title</h1><div><p>First &amp; foremost,\n  a   sentence long enough, to count.<br>more<p>Second <b>bold</b>face "
        "paragraph, also long enough, to be kept</div><div><p>Third &#233;, in a wrapper of its own, long enough</p></div></div>"
        "<div class='comments list'><p>A reader says, something long enough, to be a paragraph, honestly</p></div>"
        "<aside><p>Sidebar, words, words, words, and many more words to be long</p></aside><form><p>mail</p></form><footer>&copy;</footer>"
    )
    assert html_text.main_text(page) == (
        "Title\n\nFirst & foremost, a sentence long enough, to count. more\n\nSecond boldface paragraph, also long enough, to be kept"
        "\n\nThird é, in a wrapper of its own, long enough"
    )
    rows = [(1, None, "x"), (2, "", "y"), (3, "just text", None), (None, "<p>a < b <i>c", "z"), (5, "<div " * 3000, "q"), (6, "<p>w" * 3000, "q")]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, html string, text string")).collect()
    assert [r.text for r in got[:4]] == ["", "", "just text", "a < b c"]
    assert got[5].n_chars == len(got[5].text) == 3000 + 2 * 2999


@pytest.mark.parametrize("outer", [
    "<div class='site has-sidebar'>", "<div class='content no-comments'>", "<div id='page-with-header'>", "<div class='sidebar-left'>",
    "<div class='widget'>", "<div class='elementor-widget-wrap overflow-hidden'>", "<section id=search>", "<div id=content-sidebar-wrap class=header>",
])
@pytest.mark.parametrize("inner", ["div", "article", "main"])
def test_layout_names_keep_the_article(outer, inner):
    text = [f"Paragraph {i}, long enough to be one, with a comma or two." for i in range(4)]
    close = "</section>" if "section" in outer else "</div>"
    page = (
        f"<body><div class='cookie-banner'><p>We use cookies, for reasons, and say so here</p></div><ul class=nav><li><a href=/>Home</a></ul>{outer}"
        f"<{inner}><h2 id=related-work>Related work</h2>{''.join(f'<p>{t}</p>' for t in text)}"
        f"<ul><li><a href=1>First reference</a><li><a href=2>Second reference</a></ul><table><tr><td><a href=3>Name</a></table></{inner}>"
        f"{close}<div class='comments-area'><article><p>{'A reader, says, a lot, and more, ' * 9}</p></article></div></body>"
    )
    assert html_text.main_text(page).split("\n\n") == ["Related work", *text, "First reference", "Second reference", "Name"]
    lone = f"<body>{outer}<{inner}><p>{text[0]}</p></{inner}>{close}</body>"
    assert html_text.main_text(lone) == text[0]


def test_pages_keep_their_paragraphs(spark):
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    for row in QUERIES["op1_html_text"](spark, SMALL).collect():
        page = pages[row.page_id]
        inside = page[page.index("<article>") : page.index("</article>")].replace("<br>", "\n")
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in re.split("</?p>|</?h1>", inside)]
        assert row.text == "\n\n".join(p for p in parts if p) and row.n_chars == len(row.text)


@pytest.mark.parametrize("name, label, least", [("op2_quality_rank", "quality", 0.9), ("op3_toxicity", "toxic", 0.85)])
def test_held_out_accuracy(spark, name, label, least):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES[name](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    right = {k: [r.predicted == k for r in rows if r[label] == k] for k in (0, 1)}
    assert sum(map(sum, right.values())) / len(rows) >= least
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)


@pytest.mark.parametrize("piece", ["<b>x", "<b>words, and more<p>", "<div>a paragraph, long enough to count</i>", "<b></i></u>", "<li><b>a<td>", "<a '"])
def test_time_of_broken_pages_grows_with_their_length(piece):
    words = "The article, with its commas, and with enough words to earn points. "
    page = f"<body><article><p>{words * 4}</p></article>" + piece * (5_000_000 // len(piece))
    start = time.process_time()
    text = html_text.main_text(page)
    assert time.process_time() - start < 20 and words.strip() in text


@pytest.mark.parametrize("module", [quality_rank, toxicity])
def test_classifiers_on_odd_rows(spark, odd, none, labels, module):
    for model in (module.fit(odd, labels), module.fit(none, labels.limit(0))):
        got = module.score(odd, model)
        assert got.columns == odd.columns and got.count() == len(ODD)
        assert got.where("score is null or score not between 0 and 1").count() == 0
        assert module.score(none, model).count() == 0


def test_mix_meets_targets(spark, table, odd, none):
    plan = mixing.plan_mix(table("documents")).select("row.doc_id", "row.source", "size", "source_size", "target", F.size("draws").alias("n")).collect()
    again = mixing.plan_mix(table("documents").repartition(3)).select("row.doc_id", F.size("draws").alias("n")).collect()
    assert sorted((r.doc_id, r.n) for r in plan) == sorted((r.doc_id, r.n) for r in again)
    total = sum(r.size for r in plan)
    sources = {r.source: r for r in plan}
    assert sum(r.target for r in sources.values()) == pytest.approx(1.5 * total)
    for name, one in sources.items():
        taken = sum(r.n * r.size for r in plan if r.source == name)
        assert abs(taken - one.target) <= 0.05 * one.target + 1
    assert mixing.mix(table("documents")).count() == sum(r.n for r in plan) and max(r.n for r in plan) <= 2
    assert mixing.plan_mix(odd).count() == len(ODD) and mixing.mix(odd).columns == odd.columns
    assert mixing.plan_mix(none).count() == 0


@pytest.mark.parametrize("text", [lambda i: f"text {i} " + "w " * (i % 30), lambda i: "the same few words"])
def test_mix_meets_targets_without_ids(spark, text):
    rows = [(None, text(i), "a") for i in range(1000)] + [(7, text(i), "c") for i in range(1000)] + [(i, f"other words {i}", "b") for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    for share in (0.3, 0.9, 1.5, 2.0):
        plan = mixing.plan_mix(docs, share=share).select("row.doc_id", "row.source", "size", "target", F.size("draws").alias("n")).collect()
        assert len(plan) == len(rows)
        for name, target in {r.source: r.target for r in plan}.items():
            taken = sum(r.n * r.size for r in plan if r.source == name)
            assert abs(taken - target) <= 0.01 * target + 1
    again = mixing.plan_mix(docs.repartition(3), share=2.0).select("row.doc_id", "row.source", "size", "target", F.size("draws").alias("n")).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, plan))


def test_splitting_tree_is_exact():
    quotas = [1000, 0, 3, 77, 12]
    split = mixing.split_quotas(quotas, 7, 5)
    assert split.sum(0).tolist() == quotas and (split >= 0).all() and np.ptp(split.sum(1)) <= 3
    assert (split == mixing.split_quotas(quotas, 7, 5)).all()
    assert mixing.water_fill(150, [3, 1, 2], [20, 200, 40]) == pytest.approx([20, 90, 40])


def test_mix_against_brute_force(spark):
    random.seed(12)
    rows = [(i, " ".join("w" * random.randint(1, 3) for _ in range(random.randint(0, 30))), random.choice("aaaaaaabbc")) for i in range(20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    plan = mixing.plan_mix(docs, shards=11).selectExpr("row.doc_id", "size", "source_size", "target", "draws").collect()
    sizes = {i: len(WORD.findall(text)) for i, text, _ in rows}
    source = {i: s for i, _, s in rows}
    per = Counter()
    for i, s in source.items():
        per[s] += sizes[i]
    # Raise the common level of all shares until they use up the total.
    weight, total, low, high = dict(zip("abc", (3, 1, 2))), 1.5 * sum(per.values()), 0.0, 1e9
    for _ in range(200):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(2 * per[s], level * weight[s]) for s in per) < total else (low, level)
    taken, units = Counter(), {}
    for r in plan:
        assert (r["size"], r["source_size"]) == (sizes[r.doc_id], per[source[r.doc_id]])
        assert r.target == pytest.approx(min(2 * r.source_size, low * weight[source[r.doc_id]]), rel=1e-6)
        assert len(r.draws) <= 2 and len({d.copy for d in r.draws}) == len(r.draws)
        taken[source[r.doc_id]] += len(r.draws) * r["size"]
        for d in r.draws:
            # A block is of one shard whole.
            assert units.setdefault((source[r.doc_id], d.unit), d.shard) == d.shard
    for s, n in taken.items():
        assert abs(n - min(2 * per[s], low * weight[s])) <= 0.001 * n
    counts = [max(u for t, u in units if t == s) + 1 for s in "abc"]
    assert sum(counts) == len(units)
    found = np.zeros((11, 3), int)
    for (s, _), shard in units.items():
        found[shard, "abc".index(s)] += 1
    assert (found == mixing.split_quotas(counts, 11, 17)).all() and np.ptp(found.sum(1)) <= 4
    # Partition k is shard k.
    placed = mixing.mix(docs, shards=11).select("doc_id", F.spark_partition_id().alias("p")).collect()
    assert Counter((r.doc_id, r.p) for r in placed) == Counter((r.doc_id, d.shard) for r in plan for d in r.draws)


def test_mix_of_many_sources_is_refused(spark, docs, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_SOURCES", 3)
    with pytest.raises(ValueError, match="sources"):
        mixing.plan_mix(spark.range(9).selectExpr("id as doc_id", "'a b' as text", "cast(id as string) as source"))


def _base(text):
    words = WORD.findall(text or "")
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(runs)
    covered = {i + k for i, r in enumerate(runs) if many[r] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_rule_counts(spark, docs, odd, none, labels):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = {r.doc_id: tuple(r[n] for n in names) for r in QUERIES["op5_quality_rules"](spark, SMALL).collect()}
    assert got == {d: _base(t) for d, t in docs}
    ratios = quality_rules.fit_ratios(odd, quality_rules.trusted_ids(labels))
    rows = quality_rules.apply_rules(odd, ratios).collect()
    assert sorted(tuple(r[n] for n in names) for r in rows) == sorted(_base(r[1]) for r in ODD)
    assert not any(r.kept for r in rows if r.base_failed)
    assert quality_rules.apply_rules(none, quality_rules.fit_ratios(none, quality_rules.trusted_ids(labels.limit(0)))).count() == 0


def test_rules_run_without_python(spark):
    plan = QUERIES["op5_quality_rules"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    plan += QUERIES["op6_line_dedup"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_line_dedup_on_odd_rows(spark, none):
    rows = [(2, "A line of text\nshort\n a LINE of text", "x"), (1, "a line of text\nother line, long", "x"), (3, "\nOther line, LONG\t\nshort\n", "x"),
            (3, "A line of text", "x"), (4, None, "x"), (None, "a line of text", "x"), (5, "a line of text", None), (5, "a line of text", None)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, n_lines string"))
    found = sorted((tuple(r) for r in got.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=repr)
    assert found == sorted([(2, "short", 3, 2), (1, "a line of text\nother line, long", 2, 0), (3, "\nshort\n", 4, 1), (3, "", 1, 1),
                            (4, "", 1, 0), (None, "", 1, 1), (5, "", 1, 1), (5, "", 1, 1)], key=repr)
    assert line_dedup.dedup_lines(none).count() == 0


def test_token_files_round_trip(spark, docs, odd, none, library):
    at, expected = 0, {}
    for doc, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        expected[doc] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op7_token_files"](spark, SMALL).collect()}
    assert got == expected
    for rows in (odd, none):
        folder = scratch_path(spark, "tokens")
        back = token_files.read_token_files(spark, folder, token_files.write_token_files(rows, folder, tokenizer_path())).collect()
        assert Counter(r.doc_id for r in back) == Counter(r.doc_id for r in rows.collect())
        assert [r.start for r in sorted(back, key=lambda r: r.start)] == [0, *np.cumsum([r.n_tokens for r in sorted(back, key=lambda r: r.start)])][: len(back)]


def test_fingerprints(spark, docs, odd, none):
    got = {r.doc_id: r for r in QUERIES["op8_order_minhash"](spark, SMALL).collect()}
    for (doc, text), (after, following) in zip(docs, docs[1:] + docs[:1]):
        changed = order_minhash.edited(text, following)
        assert got[doc].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest() and got[doc].n_chars == len(text)
        assert got[doc].fingerprint == order_minhash.text_of(order_minhash.sketch(text))
        assert got[doc].near_next == order_minhash.likeness(order_minhash.sketch(text), order_minhash.sketch(following))
    text = " ".join(random.Random(1).choices(["alpha", "beta", "gamma", "delta", "eps"], k=400))
    own, half = order_minhash.sketch(text), len(text) // 2
    near, swapped = order_minhash.sketch(text[:-5]), order_minhash.sketch(text[half:] + text[:half])
    assert order_minhash.likeness(own, near) > order_minhash.likeness(own, swapped)
    assert order_minhash.compare_neighbours(odd).count() == len(ODD) and order_minhash.compare_neighbours(none).count() == 0


def _groups(docs, size, percent):
    sets = {}
    for doc, text in docs:
        words = WORD.findall((text or "").translate(ASCII_LOWER))
        sets[doc] = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} - {()}
    parent = {d: d for d in sets}

    def top(d):
        return d if parent[d] == d else top(parent[d])

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {d: (len(s), top(d)) for d, s in sets.items()}


@pytest.mark.parametrize("chunk", [2000, 5])
def test_ngram_join_finds_every_group(spark, docs, monkeypatch, chunk):
    monkeypatch.setattr(ngram_join, "CHUNK", chunk)
    random.seed(4)
    base = [f"w{i}" for i in range(60)]
    made = [(1000 + k, " ".join(w if random.random() > 0.03 else f"x{random.random()}" for w in base)) for k in range(40)]
    made += [(2000, "Ab cd"), (2001, "aB\ncd"), (2002, "ab"), (2003, None), (2004, ""), (2005, " \t")]
    rows = docs[:80] + made
    got = ngram_join.linked_components(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _groups(rows, 4, 85)


def test_ngram_join_on_odd_rows(spark, odd, none):
    got = ngram_join.linked_components(odd).collect()
    assert len(got) == len(ODD) and {r.component_id for r in got if r.doc_id in (5, 6)} == {5}
    assert ngram_join.linked_components(none).count() == 0
    left = ngram_join.one_per_group(odd)
    assert left.columns == odd.columns and sorted(r.doc_id or -1 for r in left.collect()) == [-1, -1, 1, 2, 3, 4, 5, 7]


def test_one_per_group_tells_rows_of_one_id_apart(spark, none):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a, 1), (1, b, 2), (1, b.upper(), 3), (2, a + " end", 4), (None, b + " end", 5), (None, c, 6), (None, c, 7), (8, "", 8), (8, "", 9), (None, None, 10)]
    left = ngram_join.one_per_group(spark.createDataFrame(rows, "doc_id long, text string, _id int")).collect()
    kept = sorted((r["_id"] for r in left))
    assert [k for k in kept if k not in (2, 3, 6, 7)] == [1, 8, 9, 10]
    assert len({2, 3} & set(kept)) == len({6, 7} & set(kept)) == 1 and len(kept) == 6
    got = ngram_join.linked_components(spark.createDataFrame([(5, a), (5, b), (7, a + " end"), (3, b + " end")], "doc_id long, text string"))
    assert sorted((r.doc_id, r.component_id) for r in got.collect()) == [(3, 3), (5, 3), (5, 5), (7, 5)]
    assert ngram_join.one_per_group(none).collect() == []


def test_blocks_larger_than_two_chunks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK", 6)
    random.seed(9)
    rows = []
    # Chains, whose ends share little, groups around one text, and strangers beginning alike.
    for g in range(3):
        now = [f"g{g}w{i}" for i in range(50)]
        for _ in range(25):
            now = [w if random.random() > 0.025 else f"x{random.random()}" for w in now]
            rows.append((len(rows), " ".join(now)))
        rows += [(len(rows) + k, " ".join(now[:45] + [f"y{k}z{i}" for i in range(random.choice([2, 5, 30]))])) for k in range(25)]
    random.shuffle(rows)
    got = ngram_join.linked_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _groups(rows, 5, 80)


def test_a_trie_leaves_connected_subtrees_out():
    random.seed(10)
    base = list(range(100, 160))
    paths = [np.unique(np.array(random.sample(base, 56) + random.sample(range(100), 4), np.uint64)) for _ in range(400)]
    sizes = [len(p) for p in paths]
    links = ngram_join.block_links(list(range(400)), paths, sizes, 80)
    assert len(links) == len(set(ngram_join.clusters(links))) == 399
    assert ngram_join.block_links(list(range(400)), paths, sizes, 80, [k % 2 for k in range(400)])[0] and len(
        ngram_join.block_links(list(range(400)), paths, sizes, 80, [k % 2 for k in range(400)])
    ) == 1


def test_bpe_automaton_equals_the_library(spark, docs, odd, none, library):
    machine = bpe_automaton.automaton(tokenizer_path())
    random.seed(2)
    pools = ["ab", "aaaa  \n\t", "abc 'strellvedm", "the quick of and ", " \x85\xa0　\x1c!", "éüñß日本語", "<|endoftext|>", "0123456789.,", "_²½ⓐ́x's-"]
    texts = ["".join(random.choice(random.choice(pools)) for _ in range(random.randint(0, 40))) for _ in range(1500)]
    texts += [f"a <|endoftext|> {t}<|endoftext|>" for t in texts[:200]] + [t for _, t in docs[:40]]
    coder = bpe_automaton.ChunkCoder(lambda chunks: map(machine.encode, chunks), 50)
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert [i for part in coder(text) for i in part] == ids == machine.encode(text)
        assert machine.decode(ids) == library.decode(ids, skip_special_tokens=False)
    for rows in (odd, none):
        encoded = bpe_automaton.encode_documents(rows, tokenizer_path())
        for r in bpe_automaton.decode_documents(encoded, tokenizer_path()).collect():
            assert r.decoded == (r.text or "") and r.ids == library.encode(r.text or "", add_special_tokens=False).ids
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in QUERIES["op10_bpe_automaton"](spark, SMALL).collect():
        text = dict(docs)[r.doc_id]
        ids = library.encode(text, add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), digest(",".join(map(str, ids))), digest(text))


def test_chunks_keep_the_pre_split(docs):
    split, cut = bpe_automaton.automaton(tokenizer_path())._split.findall, re.compile(bpe_automaton.CHUNK).findall
    random.seed(3)
    odd = ["".join(random.choice("ab'stre ll\n\t é漢_-.,09²½́　ⓐ🙂") for _ in range(random.randint(0, 14))) for _ in range(20_000)]
    for text in [*odd, *(t for _, t in docs)]:
        assert [w for chunk in cut(text) for w in split(chunk)] == split(text)


def test_pipeline_stages(spark, table, library):
    import corpus_pipeline

    docs = table("documents")
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = materialise(stage(spark, before, SMALL), f"test-{name}")
        if name == "toxicity":
            weights = toxicity.fit(docs, table("labels"))
            clean = {r.doc_id for r in toxicity.score(docs, weights).where("score < 0.5").collect()}
            assert {r.doc_id for r in after.collect()} == clean and 0.7 * docs.count() < len(clean) < docs.count()
        elif name == "ngram_join":
            groups = _groups([(r.doc_id, r.text) for r in before.collect()], 5, 80)
            assert sorted(r.doc_id for r in after.collect()) == sorted({top for _, top in groups.values()})
        elif name == "bpe_encoding":
            texts = {r.doc_id: r.text for r in before.collect()}
            rows = after.collect()
            assert len(rows) == before.count()
            assert all(r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids for r in rows)
        if name != "bpe_encoding":
            assert after.columns == docs.columns
        before = after


def test_unfitted_toxicity_stage_keeps_every_document(spark, table, tmp_path):
    import corpus_pipeline

    docs, labels = table("documents"), table("labels")
    for name, rows in {"empty": labels.limit(0), "null": labels.withColumn("toxic", F.lit(None).cast("int")), "strange": labels.withColumn("doc_id", -1 - F.col("doc_id"))}.items():
        rows.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        kept = corpus_pipeline.drop_toxic(spark, docs, f"{tmp_path}/{name}")
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())
