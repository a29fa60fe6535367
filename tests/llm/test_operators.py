"""Operators against plain versions, on rows with every oddity, and on empty tables."""

import itertools
import time

import brute
import numpy as np
import pytest
from odd_rows import PASSAGE, as_set, docs, empty, rows  # noqa: F401
from pyspark.sql import functions as F

from runtrail.llm import decontaminate, language, lines, mixing, quality, simhash, substrings, toxicity, urls, warc
from runtrail.llm.components import components
from runtrail.llm.lines import dedup_lines

ROWS = rows()


def ordered(values):
    return sorted(values, key=str)


@pytest.mark.parametrize("block_bytes", [4 << 20, 40])
def test_contamination(spark, docs, empty, block_bytes):
    items = [
        (1, "the cat sat on the mat AND looked at the dog"), (2, "Katze sieht"), (3, None), (4, " ... "), (5, PASSAGE),
        (None, "start of eleven"), (2, "Katze sieht"), (7, "era nunca 98765"), (8, "été été"), (9, "数"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_contamination(docs, bench, block_bytes=block_bytes, shard_bytes=5000)
    assert as_set(found, "doc_id", "n_words", "n_hit", "items") == ordered(brute.contamination(ROWS, items))
    cut = decontaminate.find_contamination(docs, bench, cut=True)
    for r in cut.collect():
        words = brute.BENCH_WORD.findall(brute.lower(r.text or ""))
        assert len(words) == r.n_words - r.n_hit
        assert sum(s.end - s.start for s in r.spans) == r.n_hit
    assert decontaminate.find_contamination(empty, bench).count() == 0
    none = decontaminate.find_contamination(docs, bench.limit(0))
    assert none.agg(F.sum("n_hit")).first()[0] == 0 and none.count() == len(ROWS)


def test_fm_index_finds_every_place():
    rng = np.random.default_rng(3)
    for size in (3, 6, 40):
        seq = np.r_[rng.integers(1, size, 700), 0]
        index = decontaminate.FMIndex(seq, size)
        assert [list(seq[i:]) for i in decontaminate.suffix_order(seq)[:50]] == sorted(list(seq[i:]) for i in range(len(seq)))[:50]
        patterns = np.array([seq[i:i + 4] for i in range(0, 600, 7)])
        low, high = index.ranges(patterns, np.full(len(patterns), 4))
        for p, a, b in zip(patterns, low, high):
            expected = [i for i in range(len(seq) - 3) if (seq[i:i + 4] == p).all()]
            assert sorted(index.locate(np.arange(a, b))) == expected


@pytest.mark.parametrize("width", [1, 5, 35])
def test_substrings(docs, empty, width, monkeypatch):
    monkeypatch.setattr(substrings, "BUCKET_WINDOWS", 5000)
    found = substrings.find_repeats(docs, width=width, shard_bytes=30000, carry=("row", "size"))
    mine = [
        (r.doc_id, r.n_words, r.n_removed, " ".join(brute.BLANK_WORD.findall(r.text or ""))) for r in found.collect()
    ]
    assert ordered(mine) == ordered(brute.substrings(ROWS, width))
    assert ordered(r.rest.row for r in found.collect()) == ordered(range(len(ROWS)))
    assert substrings.find_repeats(empty).count() == 0


def test_substring_tasks_follow_the_bytes_of_the_table(spark, docs, monkeypatch):
    monkeypatch.setattr(substrings, "TASK_BYTES", 20000)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    found = substrings.find_repeats(docs, width=5, shard_bytes=5000)
    assert found.rdd.getNumPartitions() == -(-size // 20000) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    mine = [(r.doc_id, r.n_words, r.n_removed, " ".join(brute.BLANK_WORD.findall(r.text or ""))) for r in found.collect()]
    assert ordered(mine) == ordered(brute.substrings(ROWS, 5))
    # Texts are shuffled once; replies meet them without a further exchange.
    plan = found._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("Final Plan"):plan.index("Initial Plan")]
    assert plan.count("ReusedExchange") == 2


def test_rows_equal_in_id_and_text_are_spread(spark):
    text = " ".join(f"word{i}" for i in range(40))
    hot = spark.createDataFrame([(None, text)] * 400 + [(1, "only " + text), (2, "alone")], "doc_id long, text string")
    found = substrings.find_repeats(hot.repartition(8), shard_bytes=2000).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in found) == [(0, 40, 40)] * 400 + [(1, 41, 40), (2, 1, 0)]
    # Without copies in other rows, the two of one shard still find each other.
    twice = spark.createDataFrame([(None, text)] * 2, "doc_id long, text string").repartition(2)
    assert [r.n_removed for r in substrings.find_repeats(twice).collect()] == [40, 40]


def test_packing_is_lossless():
    rng = np.random.default_rng(1)
    for width, high in ((5, 1 << 40), (8, (1 << 64) - 1)):
        values = np.unique(rng.integers(0, high, 500, dtype=np.uint64))
        assert (substrings.unpack(substrings.pack(values, width), len(values), width) == values).all()


def plain_symbols(parser, text):
    """The symbols of a text, letter by letter."""
    out = ""
    for c in text or "":
        if not c.isalpha():
            out += "" if out.endswith(chr(language.SPACE)) else chr(language.SPACE)
        elif (s := parser.letters.classes[ord(c)]) != language.OTHER:
            out += chr(s)
        else:
            code = ord(c.lower()[0])
            digits = [(code >> (5 * k)) & 31 for k in (3, 2, 1, 0)]
            out += chr(digits[0] + language.FIRST_DIGIT) + "".join(chr(d + language.LATER_DIGIT) for d in digits[1:])
    return out


SCRIPTS = {
    "en": "The quick brown fox jumps over the lazy dog while the cat sleeps in the warm house. ",
    "ja": "私は毎日図書館で本を読んでいます。東京の天気はとても良いです。電車で会社へ行きます。",
    "zh": "我每天在图书馆看书。北京的天气非常好。我们坐地铁去公司上班，晚上一起吃饭聊天。",
    "ko": "나는 매일 도서관에서 책을 읽습니다. 서울의 날씨는 매우 좋습니다.",
}


@pytest.mark.parametrize("alphabet", [0, 20, 96])
def test_scripts_of_any_size(alphabet):
    rng = np.random.default_rng(2)
    wide = {"zh": "".join(map(chr, rng.choice(np.arange(0x4E00, 0x9000), 3000))), "ja": "".join(map(chr, rng.choice(np.arange(0x3041, 0x9000), 3000)))}
    parser = language.CrossParser({k: [v, wide.get(k, "")] for k, v in SCRIPTS.items()}, 40000, alphabet)
    for name, text in SCRIPTS.items():
        assert parser.predict([text[3:25], text * 30])[0] == [name] * 2
    for name, text in wide.items():
        names, score, _, _ = parser.predict([text[500:560]])
        assert names == [name] and score[0] > 0.5


@pytest.mark.parametrize("few", [0, 8, 1000])
def test_texts_are_parsed_whole(few, monkeypatch):
    monkeypatch.setattr(language, "FEW", few)
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdeé中"), rng.integers(1, 7))) for _ in range(60)]
    text = lambda n: " ".join(rng.choice(words, n))
    reference = {"x": [text(200)], "y": [text(200)]}
    parser = language.CrossParser(reference, 2000, 4)
    texts = [text(int(n)) for n in rng.integers(0, 60, 20)] + [text(3000), None, "", text(1500)]
    found = parser.pieces(*parser.letters.symbols(texts))
    for row, name in enumerate(parser.languages):
        own = plain_symbols(parser, reference[name][0])[:2000] + chr(language.SPACE)
        assert found[row].tolist() == [brute.pieces(plain_symbols(parser, t), own) for t in texts]


def test_documents_share_the_symbols():
    assert language.shared_out([5, 100, 100, 2], 50) == [5, 21, 22, 2]
    assert language.shared_out([3, 4], 50) == [3, 4] and language.shared_out([], 9) == []


def test_a_table_that_is_too_large_is_refused():
    with pytest.raises(ValueError, match="learn fewer symbols"):
        language.CrossParser({"en": ["the cat sat on the mat"]}, 1000, 50, table_bytes=1000)


def test_language_parse_is_the_longest_match(spark):
    reference = {"en": ["the cat sat on the mat"], "de": ["die katze sitzt auf der matte"]}
    parser = language.CrossParser(reference, 1000, 50)
    texts = ["the mat on the cat", "auf die matte!! sitzt", "zzz qqq", "", None, "123", "Ünü the"]
    symbols, ends = parser.letters.symbols(texts)
    found = parser.pieces(symbols, ends)
    for row, name in enumerate(parser.languages):
        own = plain_symbols(parser, reference[name][0]) + chr(language.SPACE)
        for i, text in enumerate(texts):
            assert found[row, i] == brute.pieces(plain_symbols(parser, text), own)
    names, score, _, _ = parser.predict(texts)
    assert names[:2] == ["en", "de"] and names[3:6] == ["und"] * 3
    assert ((score >= 0) & (score <= 1)).all() and (score[3:6] == 0).all()


def test_language_of_odd_rows(spark, docs, empty):
    train = spark.createDataFrame(
        [(i, ROWS[k][1], lang) for k, lang in ((0, "en"), (1, "de"), (2, "fr")) for i in (k, k)] + [(9, None, "xx"), (10, "y", None)],
        "doc_id long, text string, lang string",
    )
    parser = language.learn_languages(train)
    assert parser.languages == ["de", "en", "fr"]
    found = {r.doc_id: r.lang_pred for r in language.predict_languages(docs, parser).collect()}
    assert (found[1], found[2], found[3], found[4], found[5], found[15]) == ("en", "de", "fr", "und", "und", "und")
    assert language.predict_languages(empty, parser).count() == 0
    nothing = language.learn_languages(train.limit(0))
    assert {r.lang_pred for r in language.predict_languages(docs, nothing).collect()} == {"und"}


def test_golay_decodes_up_to_three_errors():
    golay = simhash.Golay()
    rng = np.random.default_rng(5)
    assert len(np.unique(golay.error)) == 2048
    numbers = rng.integers(0, 4096, 300)
    words = (numbers << 11) | golay.rest[numbers]
    for weight in range(4):
        errors = np.array([sum(1 << b for b in rng.choice(23, weight, replace=False)) for _ in numbers], np.int64)
        assert (golay.decode(words ^ errors) == numbers).all()


def test_keys_meet_at_every_distance_up_to_three():
    golay, rng = simhash.Golay(), np.random.default_rng(8)
    a = rng.integers(0, 1 << 63, 2000, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 2000, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for _ in a], np.uint64)
    own = [set() for _ in a]
    for k, i in zip(*simhash.fuzzy_keys(a, golay)):
        own[i].add(k)
    other = [set() for _ in a]
    for k, i in zip(*simhash.fuzzy_keys(a ^ flips, golay)):
        other[i].add(k)
    assert all(x & y for x, y in zip(own, other))


def test_near_duplicates(docs, empty):
    found = simhash.near_duplicates(docs)
    ids, texts = zip(*ROWS)
    prints = [brute.simhash(t) for t in texts]
    expected = zip(ids, (f"{p:016x}" for p in prints), brute.groups(ids, prints))
    assert as_set(found, "doc_id", "fingerprint", "component_id") == ordered(expected)
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.first_of_groups(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    assert ordered(r.doc_id for r in kept.collect()) == ordered(set(brute.groups(ids, prints)))
    assert simhash.first_of_groups(empty).count() == 0


def test_links_span_chains_and_cliques():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 62, dtype=np.uint64)
    fps = np.unique(base ^ np.array([sum(1 << int(b) for b in rng.choice(30, 5, replace=False)) for _ in range(300)], np.uint64))
    a, b = simhash.linked(np.zeros(len(fps), np.int32), fps, 3)
    assert len(a) < len(fps)
    group = brute.groups(list(range(len(fps))), [int(x) for x in fps])
    place = {int(x): i for i, x in enumerate(fps)}
    root = list(range(len(fps)))
    for x, y in zip(a, b):
        root[place[int(x)]] = place[int(y)]
    for i in range(len(fps)):
        while root[i] != root[root[i]]:
            root[i] = root[root[i]]
    assert root == group


@pytest.mark.parametrize("longest", [100, 4096])
def test_long_runs_of_a_key_get_finer_keys(spark, longest):
    """Close and distant fingerprints of one key: the same groups, however short a run must be."""
    rng = np.random.default_rng(5)
    heart = rng.integers(0, 1 << 63, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(43, 64, (900, 7), dtype=np.uint64)
    fps = np.unique(np.r_[heart ^ np.bitwise_xor.reduce(flips, axis=1), rng.integers(0, 1 << 63, 100, dtype=np.uint64)])
    frame = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    links = simhash.fuzzy_links(frame, 3, longest)
    for r in links.collect():
        assert r.a != r.b
    roots = {r.node: r.root for r in components(links).collect()}
    apart = np.bitwise_count(fps[:, None] ^ fps[None, :])
    x, y = np.nonzero(apart <= 3)
    low = simhash.spanning(x, y, len(fps))
    groups = {}
    for f, root in zip(fps.view(np.int64).tolist(), low.tolist()):
        groups.setdefault(root, set()).add(f)
    mine = {}
    for f in fps.view(np.int64).tolist():
        mine.setdefault(roots.get(f, f), set()).add(f)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, groups.values()))
    assert 1 < len(groups) < len(fps)


def test_finer_keys_share_a_band():
    """Any two fingerprints within three bits share a finer key at every depth; a fourth of the bits goes each time."""
    rng = np.random.default_rng(6)
    a = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    flips = np.bitwise_xor.reduce(np.uint64(1) << rng.integers(0, 64, (200, 3), dtype=np.uint64), axis=1)
    left, right = a, a ^ flips
    keys = other = np.arange(200, dtype=np.uint64)
    free = np.full(200, ~np.uint64(0))
    while np.bitwise_count(free).max() > 12:
        n = np.bitwise_count(free).max()
        k, f, left4 = simhash.finer_keys(keys, free, left)
        o, _, right4 = simhash.finer_keys(other, free, right)
        shared = (k == o).reshape(simhash.BANDS, 200)
        assert shared.any(0).all()
        pick = shared.argmax(0) * 200 + np.arange(200)
        keys, other, free, left, right = k[pick], o[pick], f[pick], left4[pick], right4[pick]
        assert np.bitwise_count(free).max() <= n - n // 4

@pytest.mark.parametrize("shape", ["chain", "star", "none"])
def test_components(spark, shape):
    links = {"chain": [(i, i + 1) for i in range(70)], "star": [(500, i) for i in range(100, 160)], "none": []}[shape]
    frame = spark.createDataFrame(links + links[:3] + [(7000, 7000)], "a long, b long")
    found = {r.node: r.root for r in components(frame).collect()}
    nodes = {x for link in links for x in link}
    assert found == {n: min(nodes) for n in nodes if n != min(nodes)}


def test_quality(docs, empty):
    found = quality.judge_quality(docs)
    expected = [(i, *brute.quality(t)) for i, t in ROWS]
    assert as_set(found, "doc_id", *quality.MEASURES) == ordered(expected)
    for r in found.collect():
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (r.rejected_by is None)
    by_id = {r.doc_id: r.kept for r in found.collect()}
    assert by_id[1] and by_id[2] and not by_id[19] and not by_id[20] and not by_id[4]
    assert quality.judge_quality(empty).count() == 0


def test_rule_order_changes_no_verdict(docs):
    measured = quality.judge_quality(docs)
    verdicts = [
        as_set(measured.select("doc_id", quality.rejected_by(order).isNull().alias("kept")), "doc_id", "kept")
        for order in (list(quality.RULES), list(quality.RULES)[::-1])
    ]
    assert verdicts[0] == verdicts[1]


def test_cascade_takes_measures_in_turn(docs):
    """Where no measure is asked for, each stands within the cascade and is taken on its turn."""
    judged = quality.judge_quality(docs)
    plan = judged.select("doc_id", "kept")._jdf.queryExecution().optimizedPlan().toString()
    for measure in quality.MEASURES[1:]:
        assert f"AS {measure}#" not in plan
    assert as_set(judged.select("doc_id", "kept"), "doc_id", "kept") == as_set(judged, "doc_id", "kept")
    whole = judged._jdf.queryExecution().optimizedPlan().toString()
    assert all(f"AS {measure}#" in whole for measure in quality.MEASURES[1:])


def test_no_rule_order_takes_a_measure_early(docs):
    """Every rule first, with every other one second: only the plan is made."""
    for pair in itertools.permutations(quality.RULES, 2):
        order = [*pair, *(r for r in quality.RULES if r not in pair)]
        judged = quality.judge_quality(docs, order=order)
        plan = judged.select("doc_id", "kept")._jdf.queryExecution().optimizedPlan().toString()
        assert not any(f"AS {measure}#" in plan for measure in quality.MEASURES)


def test_a_rule_waits_for_its_turn(spark):
    """The costly rule is never asked about texts that an earlier rule has rejected."""
    def fails(m):
        return F.when(m["n_words"] < 5, F.raise_error(F.lit("asked too early"))).otherwise(m["n_letter_words"] < 0).cast("boolean")

    few, late = quality.RULES[0], quality.Rule("late", ("n_words", "n_letter_words"), fails)
    docs = spark.createDataFrame([(1, "one two"), (2, "word " * 20)], "doc_id long, text string")
    for reported in (False, True):
        found = quality.judge_quality(docs, order=[few, late], reported=reported)
        assert as_set(found, "doc_id", "rejected_by") == [(1, "few_words"), (2, None)]
        with pytest.raises(Exception, match="asked too early"):
            quality.judge_quality(docs, order=[late, few], reported=reported).select("kept").collect()


def test_rules_are_ordered_by_rejections_per_cost(docs, monkeypatch):
    clock = iter(range(10**6))
    monkeypatch.setattr(quality.time, "perf_counter", lambda: next(clock))
    ordered = quality.order_rules(docs.select("doc_id", "text"))
    by_name = {r.name: docs.select("text", quality.words_of(F.col("text")).alias("words")).where(
        r.over(quality.measures(F.col("text"), F.col("words")))).count() for r in quality.RULES}
    assert [by_name[r.name] for r in ordered] == sorted(by_name.values(), reverse=True)


def test_reported_measures_give_the_same_verdicts(docs):
    own, read = quality.judge_quality(docs), quality.judge_quality(docs, reported=True)
    columns = ("doc_id", *quality.MEASURES, "base_failed", "kept")
    assert as_set(own, *columns) == as_set(read, *columns)
    assert {r.doc_id: r.rejected_by for r in quality.judge_quality(docs, order=list(quality.RULES)).collect()}[15] == "few_words"


def test_archives(spark):
    page = "<html>" + "x" * 1200 + "</html>"
    data = [
        (1, "http://a/", page), (2, "http://b/ c\r\n", page), (2, "http://b/", page), (3, None, "short"), (4, "u", "short"),
        (5, "u", None), (6, "u", ""), (None, "u", page), (None, None, "é" * 600), (7, "u", "é" * 600), (8, "u", "z" * 700_000),
        (9, "u", "\r\n\r\nWARC/1.1\r\n\r\n"),
    ]
    pages = spark.createDataFrame([(*d, "x") for d in data], "page_id long, url string, html string, digest string")
    index = warc.write_archives(pages.repartition(2))
    found = warc.read_records(index).collect()
    sizes = ordered((None if i is None else str(i), len((h or "").encode())) for i, _, h in data)
    assert ordered((r.page_id, r.payload_bytes) for r in found) == sizes
    kinds = {(r.page_id, r.record_type, r.refers_to) for r in found}
    assert {("1", "revisit", "2"), ("2", "response", None), (None, "revisit", "2"), (None, "revisit", "7")} <= kinds
    assert {("3", "response", None), ("4", "response", None), ("5", "response", None)} <= kinds
    texts = {r.page_id: bytes(r.payload).decode() for r in found if r.payload is not None}
    assert texts["8"] == "z" * 700_000 and texts["9"] == data[-1][2] and texts["2"] == page
    one = warc.read_records(index.where("page_id = '8'")).collect()
    assert [r.page_id for r in one] == ["8"]
    assert warc.read_records(warc.write_archives(pages.limit(0))).count() == 0


def test_records_have_ids_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 2000)
    ids = ["", "a\r\nX: y", "<urn:page:1>", "é %41:7", ":", None, None, "twice", "twice", "zz", "zz"]
    data = [(i, "u", "same payload " * 100) for i in ids]
    pages = spark.createDataFrame(data, "page_id string, url string, html string").repartition(3)
    index = warc.write_archives(pages)
    records = warc.read_records(index)
    assert records.rdd.getNumPartitions() > 1
    found = records.collect()
    assert ordered(r.page_id for r in found) == ordered(ids)
    assert ordered((r.record_type, r.refers_to) for r in found) == ordered([("revisit", "é %41:7")] * 10 + [("response", None)])
    urns = set()
    for r in index.collect():
        head = warc.BundleReader(r.bundle).frame(r.frame)[r.offset:r.offset + r.length].split(b"\r\n\r\n")[0]
        urns.add(next(line for line in head.split(b"\r\n") if line.startswith(b"WARC-Record-ID")))
    assert len(urns) == len(ids)


def test_one_block_of_a_benchmark_is_held_at_a_time(spark, docs):
    bench = spark.createDataFrame([(i, f"item number {i} of many words") for i in range(50)], "item_id long, text string")
    blocks = decontaminate.benchmark_blocks(bench, "item_id", "text", 100)
    assert len(blocks) > 10
    for block in decontaminate.in_turn(blocks, 10):
        assert len(block.names) > 0 and not any("_value" in vars(b) for b in blocks)


def test_bundles_are_plain_zstandard(spark, tmp_path):
    import zstandard

    pages = spark.createDataFrame([(i, "u", f"page {i} " * 9000) for i in range(30)], "page_id long, url string, html string")
    index = warc.write_archives(pages.coalesce(1), folder=str(tmp_path / "w")).collect()
    assert len({r.frame for r in index}) > 3
    with open(index[0].bundle, "rb") as f:
        whole = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\n") == 30


def test_url_rules_and_list(spark):
    urls_of = [
        (1, "http://A.Example.net/x"), (2, "https://example.net/en/1?utm_x=1"), (3, "http://b.example.com/de/"), (4, "http://c.org/fr/a"),
        (5, "http://other.io/p?utm_source=f"), (6, "http://other.io/p#top"), (7, "http://other.io/q"), (8, None), (9, "no scheme"),
        (10, "http://example.net"), (11, "http://notexample.com/de/"), (12, "http://other.io/p?a=1&utm_s=2"), (12, "http://other.io/p"), (None, "ftp://X.org?u"),
    ]
    from runtrail.llm.queries import TRACKED, URL_RULES

    pages = spark.createDataFrame([(i, u, "h", 1) for i, u in urls_of], "page_id long, url string, host string, h1 int")
    expected = [
        (1, "a.example.net", "/x", "net/", "block"), (2, "example.net", "/en/1", "example.net/en/", "allow"),
        (3, "b.example.com", "/de/", "example.com/de/", "block"), (4, "c.org", "/fr/a", "org/fr/", "allow"),
        (5, "other.io", "/p", None, "block"), (6, "other.io", "/p", None, "block"), (7, "other.io", "/q", None, "allow"),
        (8, "", "", None, "allow"), (9, "", "", None, "allow"), (10, "example.net", "", None, "allow"),
        (11, "notexample.com", "/de/", None, "allow"), (12, "other.io", "/p", None, "block"),
        (12, "other.io", "/p", None, "block"), (None, "x.org", "", None, "allow"),
    ]
    lists = F.coalesce(F.expr(TRACKED), F.lit(False))
    for max_bits in (1 << 28, 40):
        found = urls.filter_urls(pages, URL_RULES, lists, max_bits=max_bits)
        assert as_set(found, "page_id", "host", "path", "rule", "verdict") == ordered(expected)
    assert urls.filter_urls(pages.limit(0), URL_RULES, lists).count() == 0


def test_cascade_is_exact(spark):
    keys = spark.range(5000).select(F.col("id").cast("string").alias("key"))
    listed = keys.where("key % 3 = 0")
    found = urls.member_of_list(keys, listed, "key")
    assert found.where("listed <> (key % 3 = 0)").count() == 0
    assert not spark.sparkContext._jsc.getPersistentRDDs()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan


def test_mix(spark, docs, empty):
    found = mixing.mix_sizes(docs).collect()
    sizes = {}
    for r in found:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    goal = brute.targets(sizes)
    for source, target in goal.items():
        own = [r for r in found if r.source == source]
        assert all(abs(r.target - target) < 1e-6 * max(1, target) and r.source_size == sizes[source] for r in own)
        assert abs(sum(r.taken for r in own) - target) <= max(r.size for r in own)
        assert all(0 <= r.taken <= 2 * r.size for r in own)
    assert ordered(map(tuple, found)) == ordered(map(tuple, mixing.mix_sizes(docs).collect()))
    assert mixing.mix_sizes(empty).count() == 0


def test_the_cut_of_the_one_order_decides(spark, docs):
    plain = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    assert as_set(mixing.mix_sizes(docs), "doc_id", "size", "taken") == ordered(brute.mix(plain))
    rng = np.random.default_rng(3)
    plain = [(i, "w " * int(rng.integers(0, 90)), f"s{i % 7}") for i in range(280)]
    sizes = mixing.mix_sizes(spark.createDataFrame(plain, "doc_id long, text string, source string").repartition(3)).collect()
    found = ordered((r.doc_id, r.size, r.taken) for r in sizes)
    assert found == ordered(brute.mix(plain)) != ordered(brute.mix(plain, cut=False))
    # Nothing else cuts a source at its target: most end within a document of it, one is cut.
    over = {r.source: sum(x.taken for x in sizes if x.source == r.source) - r.target for r in sizes}
    assert all(abs(v) <= 90 for v in over.values()) and any(v > 1 for v in over.values()) and any(v < -1 for v in over.values())


def test_mixed_documents(docs, empty):
    mixed = mixing.mix_documents(docs).orderBy("mix_start").collect()
    at = 0
    for r in mixed:
        assert r.mix_start == at
        at += r.mix_taken
        assert len(brute.BLANK_WORD.findall(r.text)) == r.mix_taken
    by_row = {}
    for r in mixed:
        by_row[r["row"]] = by_row.get(r["row"], 0) + r.mix_taken
    assert sum(by_row.values()) == sum(r.taken for r in mixing.mix_sizes(docs).collect())
    assert mixing.mix_documents(docs).columns == docs.columns + ["mix_copy", "mix_taken", "mix_start"]
    assert mixing.mix_documents(empty).count() == 0


def votes_of_known_voters(n=6000):
    """Classes, an annotator who is wrong on a tenth, and six voters of known rates."""
    draw = np.random.default_rng(11)
    toxic = draw.random(n) < 0.3
    rates = np.array([[0.02, 0.05, 0.10, 0.01, 0.20, 0.05], [0.60, 0.50, 0.40, 0.30, 0.55, 0.70]])
    votes = (draw.random((n, 6)) < rates[toxic.astype(int)]).astype(float)
    labels = (toxic ^ (draw.random(n) < 0.1)).astype(int)
    return toxic, rates, votes, labels


def test_label_model_finds_the_voters_rates():
    toxic, rates, votes, labels = votes_of_known_voters()
    p, model = toxicity.label_model(votes, labels)
    assert np.abs(model.alone - rates).max() < 0.04
    assert np.abs(model.annotator - [0.1, 0.9]).max() < 0.03
    assert abs(model.prior[1] - 0.3) < 0.03
    assert ((p > 0.5) == toxic).mean() > max(0.95, (labels == toxic).mean())
    assert (model.parent == -1).all()


def test_label_model_counts_voters_that_repeat_each_other_once():
    toxic, _, votes, labels = votes_of_known_voters()
    plain, _ = toxicity.label_model(votes, labels)
    repeated, model = toxicity.label_model(np.c_[votes, votes[:, [4] * 5]], labels)
    assert np.abs(plain - repeated).mean() < 0.01
    copies = [4, 6, 7, 8, 9, 10]
    assert sorted(model.parent[copies] >= 0) == [False] + [True] * 5
    assert set(model.parent[copies]) <= {-1, *copies}
    # Without the forest the copies outvote the rest.
    model.parent[:] = -1
    model.fires = np.stack([model.alone, model.alone], 1)
    assert np.abs(plain - model.posterior(np.c_[votes, votes[:, [4] * 5]], labels)).mean() > 0.02


def test_label_model_learns_how_voters_depend():
    toxic, _, votes, labels = votes_of_known_voters()
    draw = np.random.default_rng(5)
    # Fires on 0.9 of the rows where the first voter does, on 0.1 of the others.
    follower = draw.random(len(votes)) < np.where(votes[:, 0] == 1, 0.9, 0.1)
    _, model = toxicity.label_model(np.c_[votes, follower], labels)
    child, other = (6, 0) if model.parent[6] >= 0 else (0, 6)
    assert model.parent[child] == other
    if child == 6:
        assert np.abs(model.fires[1, :, 6] - [0.1, 0.9]).max() < 0.04


def test_label_model_of_odd_votes():
    """No voter at all, one that always fires, one that never does; rows that repeat."""
    labels = np.array([1, 0, 0, 0] * 20)
    p, _ = toxicity.label_model(np.zeros((80, 0)), labels)
    assert p.shape == (80,) and np.isfinite(p).all()
    p, _ = toxicity.label_model(np.c_[np.ones(80), np.zeros(80), labels, labels], labels)
    assert ((p > 0.5) == (labels == 1)).all()


def test_toxicity(spark, docs, empty):
    insult = ["you idiot", "what a moron", "loserling talk"]
    train = [(i, f"plain words number {i} about the weather and the garden" + (" " + insult[i % 3] if i % 4 == 0 else "")) for i in range(240)]
    labels = [(i, int(i % 4 == 0)) for i in range(240)] + [(3, None), (0, 0), (None, 1), (99999, 1)]
    frame = spark.createDataFrame(train, "doc_id long, text string")
    model = toxicity.learn_toxicity(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))
    tests = spark.createDataFrame([(1, "the garden, idiot"), (2, "the garden"), (3, None), (4, ""), (5, "LOSERLINGS about")], "doc_id long, text string")
    score = {r.doc_id: r.score for r in toxicity.score_toxicity(tests, model).collect()}
    assert score[1] > 0.3 and score[5] > 0.3 and max(score[2], score[3], score[4]) < 0.3
    assert toxicity.score_toxicity(docs, model).count() == len(ROWS)
    assert toxicity.score_toxicity(empty, model).count() == 0
    none = toxicity.learn_toxicity(frame, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score < 0.01 for r in toxicity.score_toxicity(tests, none).collect()} == {True}
    ones = toxicity.learn_toxicity(frame, spark.createDataFrame([(i, 1) for i, _ in labels], "doc_id long, toxic int"))
    assert {r.score > 0.99 for r in toxicity.score_toxicity(tests, ones).collect()} == {True}


def test_lines(docs, empty):
    found = dedup_lines(docs, carry=("row", "rest"))
    mine = [(r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in found.collect()]
    assert ordered(mine) == ordered(brute.lines(ROWS))
    assert dedup_lines(empty).count() == 0


@pytest.mark.parametrize("hot", [1, 4096])
def test_hot_lines_meet_their_answers_by_broadcast(docs, hot, monkeypatch):
    monkeypatch.setattr(lines, "HOT", hot)
    mine = [(r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in dedup_lines(docs).collect()]
    assert ordered(mine) == ordered(brute.lines(ROWS))


def test_texts_of_many_lines_take_time_in_proportion(spark):
    def frame(n):
        own = [(1, "\n".join(f"common line number {i}" for i in range(0, n, 2))), (2, "\n".join(f"common line number {i}" for i in range(n)))]
        return spark.createDataFrame(own, "doc_id long, text string")

    def seconds(n):
        began = time.perf_counter()
        found = {r.doc_id: r for r in dedup_lines(frame(n)).collect()}
        assert (found[2].n_dropped, found[2].text) == (n // 2, "\n".join(f"common line number {i}" for i in range(1, n, 2)))
        return time.perf_counter() - began

    seconds(1000)
    assert seconds(80000) < 5 * max(seconds(20000), 1.0)


def test_lines_are_hashed_once(docs):
    plan = dedup_lines(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "explode" not in plan


@pytest.mark.parametrize("values", [[0.5], [0.25, 0.5], [0.125] * 500, [n * n / 7 for n in range(900)], [0.0] * 800 + [1e9, 2e9]])
def test_percentiles_are_exact(spark, monkeypatch, values):
    monkeypatch.setattr(language, "FEW_VALUES", 5)
    table = spark.createDataFrame([(v,) for v in values], "v double")
    for share in (0.0, 0.5, 0.999, 1.0):
        assert language.exact_percentile(table, "v", share) == pytest.approx(table.selectExpr(f"percentile(v, {share}D)").first()[0], rel=1e-12)


def test_the_rejection_limit_heeds_all_labelled_texts(spark):
    """Odd texts far behind the first in the order of the ids' hashes raise the limit too."""
    prose = "the quick brown fox jumps over the lazy dog and runs away from the hounds again "
    odd = "zq xj kv wq pz vx qk jx zv kq xw vz qj kx zw jq vk xz qw kj zx vq "
    rows = [(n, prose, "en") for n in range(1200)]
    place = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    last = {r.doc_id for r in place.orderBy(F.xxhash64("doc_id").desc()).limit(60).collect()}
    docs = spark.createDataFrame([(n, odd if n in last else prose, "en") for n in range(1200)], "doc_id long, text string, lang string")
    parser = language.learn_languages(docs)
    plain = language.rejection_limit(place, parser)
    assert language.rejection_limit(docs, parser) > 1.5 * plain
