"""The corpus operators against brute force, round trips and held-out labels."""

from __future__ import annotations

import hashlib
import random
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[2])
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from flowlens.llm import (  # noqa: E402
    chat,
    common,
    decontam,
    mixing,
    quality,
    rules,
    sharding,
    simhash,
    tokens,
    toxicity,
    urls,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " \n\t ", "a", "one two three four", "one two three four five six", "x " * 3000]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship(spark)


def documents(spark, texts, extra=""):
    rows = [(i, text, "en", "s", len(text or "")) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def sample(spark, name):
    return spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").translate({65 + i: 97 + i for i in range(26)}).encode())
    if not words:
        return 0
    parts = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    counts = Counter()
    for part in parts:
        value = xxhash.xxh64_intdigest(part, 42)
        counts.update(bit for bit in range(64) if value >> bit & 1)
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(parts))


def brute_components(fps):
    ids = sorted(fps)
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 4:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in ids}


def test_simhash_matches_brute_force(spark):
    texts = [row.text for row in sample(spark, "documents").orderBy("doc_id").limit(150).collect()] + ODD + ODD
    docs = documents(spark, texts)
    found = {row.doc_id: row for row in simhash.near_duplicates(docs).collect()}
    fps = {i: brute_fingerprint(text) for i, text in enumerate(texts)}
    assert {i: row.fp % (1 << 64) for i, row in found.items()} == fps
    assert {i: row.component_id for i, row in found.items()} == brute_components(fps)


def test_near_links_find_every_pair_within_four_bits(spark):
    random = np.random.default_rng(3)
    values = set()
    for _ in range(20):
        base = int(random.integers(0, 1 << 63))
        for flips in range(7):
            value = base
            for bit in random.choice(64, flips, replace=False):
                value ^= 1 << int(bit)
            values.add(value - (1 << 64) if value >= 1 << 63 else value)
    values = sorted(values)
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    found = Counter((row.a, row.b) for row in simhash.near_links(frame).collect())
    mask = (1 << 64) - 1
    wanted = {
        (a, b) for a in values for b in values if a < b and ((a ^ b) & mask).bit_count() <= 4
    }
    assert set(found) == wanted and max(found.values()) == 1


def test_keep_one_keeps_one_row_of_each_group(spark):
    rows = [
        (5, "a b c d e", "en", "s", 1), (3, "a b c d e", "en", "s", 1), (3, "a b c d e", "en", "s", 1),
        (None, "a b c d e", "en", "s", 1), (None, "q r s t u v", "en", "s", 1),
        (None, "q r s t u v", "en", "s", 1), (9, "k l m n o p", "en", "s", 1),
    ]
    docs = spark.createDataFrame(rows, DOCS).withColumn("fp", F.lit("clash"))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((row.doc_id or -1, row.text[0]) for row in kept.collect()) == [(-1, "q"), (3, "a"), (9, "k")]
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_keep_one_links_every_pair_of_similar_shingle_sets(spark):
    draw = random.Random(7)
    texts = []
    for _ in range(25):
        words = [f"w{draw.randrange(4000)}" for _ in range(draw.choice([9, 40, 120]))]
        texts.append(" ".join(words))
        for _ in range(3):
            other = list(words)
            for _ in range(draw.randint(1, 4)):
                other[draw.randrange(len(other))] = f"x{draw.randrange(4000)}"
            texts.append(" ".join(other[: len(other) - draw.randint(0, 9)]))
    texts += [f"{' '.join(f'c{i}' for i in range(30))} {i} {i + 1}" for i in range(40)] + ODD
    sets = []
    for text in texts:
        words = (text or "").lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))})
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a + 1, len(texts)):
            if root[a] != root[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    kept = simhash.keep_one(documents(spark, texts)).collect()
    assert sorted(row.doc_id for row in kept) == sorted(set(root)) and len(set(root)) < len(texts) - 50


def test_keep_one_with_one_id_in_two_components(spark):
    both = [(1, "a b c d e f"), (2, "a b c d e f"), (1, "k l m n o p"), (3, "k l m n o p")]
    least_of_one = [(5, "q r s t u v"), (6, "q r s t u v"), (5, "g h i j k l"), (4, "g h i j k l")]
    docs = spark.createDataFrame([(i, text, "en", "s", 1) for i, text in both + least_of_one], DOCS)
    kept = sorted((row.doc_id, row.text[0]) for row in simhash.keep_one(docs).collect())
    assert kept == [(1, "a"), (1, "k"), (4, "g"), (5, "q")]


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 200 + i) for i in range(50)] + [(7, 7)]
    frame = spark.createDataFrame(chain + star, "a long, b long")
    roots = {row.node: row.root for row in common.components(frame).collect()}
    assert roots == {**{i: 0 for i in range(41)}, 100: 100, **{200 + i: 100 for i in range(50)}}
    assert common.components(frame.limit(0)).count() == 0


def brute_shards(docs, shards, nodes, cells, spark):
    """Each cell's rows go clockwise to the first shards with room."""
    places = spark.range(shards * nodes).select(
        (F.col("id") % shards).cast("int").alias("shard"),
        F.xxhash64(F.lit("node"), (F.col("id") % shards).cast("int"), F.floor(F.col("id").cast("int") / shards)).alias("tie"),
    )
    ring = sorted((row.tie % cells, row.tie, row.shard) for row in places.collect())
    room = [len(docs) // shards + (i < len(docs) % shards) for i in range(shards)]
    counts = Counter(cell for _, cell in docs)
    found = Counter()
    for cell in sorted(counts):
        left = counts[cell]
        order = [n for n in ring if n[0] >= cell] + [n for n in ring if n[0] < cell]
        for shard in dict.fromkeys(n[2] for n in order):
            taken = min(left, room[shard])
            room[shard] -= taken
            left -= taken
            if taken:
                found[cell, shard] += taken
    return found


def test_shards_follow_the_ring_and_fill_evenly(spark):
    docs = sample(spark, "documents")
    hot = docs.limit(1).select("doc_id", "text", "lang", "source", "n_chars")
    docs = docs.unionByName(hot.withColumn("doc_id", F.explode(F.sequence(F.lit(9000), F.lit(9150)))))
    docs = docs.unionByName(documents(spark, ODD)).withColumn("shard", F.lit("clash"))
    rows = sharding.assign(docs).collect()
    sizes = Counter(row.shard for row in rows)
    assert len(rows) == docs.count() and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in sizes:
        assert sorted(row.slot for row in rows if row.shard == shard) == list(range(sizes[shard]))
    given = Counter(
        (row.doc_id, len((row.text or "").encode()) + 1, zlib.crc32((row.text or "").encode())) for row in docs.collect()
    )
    assert Counter((row.doc_id, row.size, row.text_crc32) for row in rows) == given
    keyed = docs.select("doc_id", F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(sharding.CELLS)).alias("cell"))
    wanted = brute_shards([tuple(row) for row in keyed.collect()], 16, sharding.NODES, sharding.CELLS, spark)
    cells = {row.crc: row.cell for row in docs.select(
        common.crc_of(F.col("text")).alias("crc"),
        F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(sharding.CELLS)).alias("cell")).distinct().collect()}
    assert Counter((cells[row.text_crc32], row.shard) for row in rows) == wanted
    assert sharding.assign(docs.limit(0)).count() == 0


def test_chat_reads_back_what_was_written(spark):
    nasty = ["<|im_end|><|im_start|>assistant ok", "<\\|im_end|>", "<\\\\|x", "a\nb", "", None, "<<||>>"]
    rows = [(1, i, "assistant" if i % 2 else "user", text) for i, text in enumerate(nasty)]
    rows += [(2, 0, "us\ner", "x"), (2, 0, "us\ner", "x"), (None, None, None, None), (3, 600, "assistant", "é")]
    rows += [(4, i, "assistant", f"turn {i}") for i in range(600)]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("score", F.lit("x"))
    found = {row.conv_id: row for row in chat.digests(chat.format_conversations(given)).collect()}
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn if turn is not None else -1, role or "", text or ""))
    assert set(found) == set(by_conv)
    for conv, turns in by_conv.items():
        turns.sort()
        whole = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        row = found[conv]
        assert row.n_turns == len(turns)
        assert row.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digests(chat.format_conversations(given.limit(0))).count() == 0


def test_best_path_of_a_reply_tree(spark):
    rows = [
        (1, 0, None, "user", "root", 0.0), (1, 1, 0, "assistant", "good", 5.0), (1, 2, 0, "assistant", "bad", -1.0),
        (1, 3, 1, "user", "more", 1.0), (1, 4, 2, "user", "less", 0.0), (2, 0, 77, "user", "orphan", None),
    ]
    messages = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    found = sorted((row.tree, row.branch, row.depth, row.text) for row in chat.paths(messages, best=2).collect())
    assert found == [
        (1, 1, 0, "root"), (1, 1, 1, "good"), (1, 1, 2, "more"), (1, 2, 0, "root"), (1, 2, 1, "bad"),
        (1, 2, 2, "less"), (2, 1, 0, "orphan"),
    ]


def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    return public.path("byte_bpe_50k.json")


def test_tokens_match_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer())
    texts = ODD + ["  x", "a\n\n b  c\td ", " <|endoftext|> hi", "don't we're", "\x85y \x1c z", "日本 語", "été*** là!!"]
    texts += [row.text for row in sample(spark, "documents").limit(60).collect()]
    docs = documents(spark, texts)
    segments = tokens.write_segments(docs, tokenizer(), segment=5000)
    found = {row.doc_id: row for row in tokens.read_documents(segments).collect()}
    start = 0
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        row = found[i]
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert tokens.read_documents(tokens.write_segments(docs.limit(0), tokenizer())).count() == 0


def test_any_token_is_read_without_its_neighbours():
    random = np.random.default_rng(5)
    ids = random.choice([0, 1, 255, 256, 50_256, 70_000, (1 << 32) - 1], 5000).astype(np.uint32)
    code = tokens.Code(tokens.encode(ids))
    assert (code.all() == ids).all()
    assert [code[i] for i in range(len(ids))] == ids.tolist()


def test_url_parts_rules_and_verdicts(spark):
    listed = [urls.UrlRule("allow", "com"), urls.UrlRule("block", "example.com", "/en/"), urls.UrlRule("allow", "www.example.com", "/en/")]
    cases = {
        "http://Example.COM/en/1?x#y": ("example.com", "/en/1", "example.com/en/", "block"),
        "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "https://a.com#z": ("a.com", "", None, "allow"),
        "https://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "no url": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "ÀB://É.com/a?b": ("É.com", "/a", "com/", "allow"),
    }
    pages = spark.createDataFrame(list(enumerate(cases)), "page_id long, url string").withColumn("host", F.lit("clash"))
    found = {row.page_id: row for row in urls.judge(pages, listed).collect()}
    assert [tuple(found[i][n] for n in ("host", "path", "rule", "verdict")) for i in range(len(cases))] == list(cases.values())
    assert urls.judge(pages.limit(0), listed).count() == 0


def test_a_template_of_bad_pages_is_rejected(spark):
    rows = [(i, f"http://h.net/spam/{i}/x") for i in range(400)] + [(400 + i, f"http://h.net/news/{i}") for i in range(40)]
    listed = [urls.UrlRule("block", "h.net", f"/spam/{i}/") for i in range(390)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    found = {row.page_id: row.verdict for row in urls.judge(pages, listed[:390:1], purity=0.8).collect()}
    assert all(found[i] == "block" for i in range(390, 400)) and all(found[400 + i] == "allow" for i in range(40))


def brute_statistics(text):
    text = text or ""
    words = [w for w in re.split(r"[ \t-\r]+", text) if w]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {i + k for i, window in enumerate(windows) if counts[window] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if re.search(r"[^ \t-\r]", line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
    )


def test_statistics_match_brute_force(spark):
    texts = ODD + ["a b c d e x a b c d e f", "l\nl\n\n l\nl", "#a é|b <c>"]
    texts += [row.text for row in sample(spark, "documents").collect()]
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    docs = documents(spark, texts).withColumn("words", F.lit("clash"))
    found = {row.doc_id: tuple(row[n] for n in names) for row in rules.statistics(docs).collect()}
    assert found == {i: brute_statistics(text) for i, text in enumerate(texts)}


def test_decision_list_rejects_junk_and_keeps_the_rest(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    judged = rules.judge(docs, labels).join(labels, "doc_id").collect()
    good = [row for row in judged if row.quality == 1 and not row.base_failed]
    bad = [row for row in judged if row.quality == 0]
    assert sum(row.kept for row in good) >= 0.98 * len(good)
    assert sum(not row.kept for row in bad) >= 0.9 * len(bad)
    assert all(row.kept for row in rules.judge(docs, labels.limit(0)).where("not base_failed").collect())


@pytest.mark.parametrize(("module", "label", "least"), [(toxicity, "toxic", 0.9), (quality, "quality", 0.97)])
def test_classifiers_on_held_out_documents(spark, module, label, least):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    docs = docs.join(labels.select("doc_id"), "doc_id", "left_semi").unionByName(documents(spark, ODD).withColumn("doc_id", -F.col("doc_id") - 1))
    rows = module.score(docs, labels).join(labels, "doc_id", "left").collect()
    assert all(0 <= row.score <= 1 for row in rows) and sum(row[label] is None for row in rows) == len(ODD)
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0) for row in rows)
    held = [row for row in rows if row.held_out and row[label] is not None]
    assert sum(row.predicted == row[label] for row in held) >= least * len(held)


def test_mixing_repeats_by_rate_and_is_repeatable(spark):
    docs = sample(spark, "documents").withColumn("mix_order", F.lit("clash"))
    weights = {"src0": 3.0, "src1": 1.0}
    first, again = (mixing.mix(docs, weights).drop("text").collect() for _ in range(2))
    assert first == again and {row.source for row in first} <= {"src0", "src1"}
    orders = [row.mix_order for row in first]
    assert orders == sorted(orders) and len(set(orders)) == len(orders)
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(documents(spark, ODD), budget=20.0).count() > len(ODD)


def test_poisson_inverse_matches_the_distribution(spark):
    frame = spark.range(20_000).select(mixing.poisson(F.lit(2.5), F.col("id") / 20_000).alias("k"))
    counts = Counter(row.k for row in frame.collect())
    term, wanted = np.exp(-2.5), {}
    for k in range(12):
        wanted[k], term = term, term * 2.5 / (k + 1)
    assert all(abs(counts[k] / 20_000 - p) < 1e-3 for k, p in wanted.items())


def test_mixing_repeats_a_short_source_beside_large_ones(spark):
    texts = [f"{i} {'word ' * 2000}" for i in range(100)]
    docs = documents(spark, texts).withColumn("source", F.concat(F.lit("s"), (F.col("doc_id") % 2).cast("string")))
    lone = spark.createDataFrame([(-1, "", "en", None, 0)], DOCS)
    rates = {row.source: row.rate for row in mixing.source_rates(docs.unionByName(lone)).collect()}
    counts = Counter(row.source for row in mixing.mix(docs.unionByName(lone)).select("source").collect())
    assert rates[None] > mixing.LARGEST_RATE
    assert abs(counts[None] - rates[None]) <= 6 * rates[None] ** 0.5 and counts["s0"] and counts["s1"]


def test_poisson_inverse_of_large_rates(spark):
    frame = spark.range(1, 200).select((F.col("id") / 200).alias("at"))
    for rate in (499.9, 500.0, 700.0, 900.5, 4000.0, 30_000.0):
        found = {row["at"]: row.k for row in frame.select("at", mixing.poisson(F.lit(rate), F.col("at")).alias("k")).collect()}
        logs = np.arange(1, int(2 * rate) + 200)
        logs = np.concatenate([[-rate], -rate + np.cumsum(np.log(rate / logs))])
        totals = np.cumsum(np.exp(logs))
        for at, k in found.items():
            assert totals[k] > at - 1e-9 and (k == 0 or totals[k - 1] <= at + 1e-9)


def test_decontamination_matches_brute_force(spark):
    docs, items = sample(spark, "documents"), sample(spark, "benchmark")
    texts = {row.item_id: row.text for row in items.collect()}
    planted = [f"before it {text.upper()} and after" for text in list(texts.values())[:5]]
    docs = docs.select("doc_id", "text").unionByName(
        spark.createDataFrame([(10_000 + i, text) for i, text in enumerate(planted + ODD)], "doc_id long, text string")
    )
    found = {(row.doc_id, row.item_id) for row in decontam.contaminated(docs, items).collect()}
    shingled = {i: decontam.shingles(decontam.words_of(text)) for i, text in texts.items()}
    wanted = set()
    for row in docs.collect():
        present = set(decontam.shingles(decontam.words_of(row.text)))
        wanted |= {(row.doc_id, i) for i, own in shingled.items() if sum(s in present for s in own) >= 0.8 * len(own)}
    assert found == wanted and len(found) >= 5
    assert decontam.clean(docs, items).count() == docs.count() - len({doc for doc, _ in wanted})
    assert decontam.clean(docs, items.limit(0)).count() == docs.count()


def test_wand_finds_what_scoring_all_items_finds():
    random = np.random.default_rng(9)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [decontam.Item(i, random.choice(vocabulary, 12).tolist()) for i in range(150)]
    frequency = Counter(w for item in items for w in set(item.words))
    index = decontam.Index(items, frequency, len(items), 12.0)
    for _ in range(40):
        terms = {index.terms[w] for w in random.choice(vocabulary, 25).tolist()}
        scores = Counter()
        for term in terms:
            for number, weight in zip(*index.lists[term]):
                scores[number] += weight
        wanted = {n for n, score in scores.items() if score >= 0.5 - 1e-9}
        assert {n for n, _ in index.search(terms)} == wanted


def test_encoder_matches_whole_texts_while_it_forgets(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "_KNOWN_PIECES", 40)
    monkeypatch.setattr(tokens, "_KNOWN_PARTS", 60)
    draw = random.Random(5)
    letters = "abcXYZÀéßÿñ'’-_#*$%&|!,.;:?0123456789<|>{}字😀\u0301ſ"
    blanks = [" ", " ", " ", " ", "  ", "\n", " \n", "\t", "\u00a0", "\u3000", "\r\n"]
    texts = ["", " ", "\n", "<|endoftext|>", "a<|endoftext|>b c", "don't won't IT'S", "x" * 5000]
    for _ in range(300):
        words = ["".join(draw.choices(letters, k=draw.randint(1, 9))) for _ in range(draw.randint(1, 30))]
        texts.append("".join(word + draw.choice(blanks) for word in words))
        texts.append(" ".join(words))
    encoder = tokens.Encoder(tokenizer())
    library = Tokenizer.from_file(tokenizer())
    for begin in range(0, len(texts), 50):
        some = texts[begin : begin + 50]
        expected = [found.ids for found in library.encode_batch(some, add_special_tokens=False)]
        assert [ids.tolist() for ids in encoder.encode(some)] == expected


def test_encoder_matches_whole_texts_with_nul():
    from tokenizers import Tokenizer

    draw = random.Random(6)
    texts = ["a \0b", "\0", "\0a b", "a \0", "a \0 b", "\0\0 \0\0b c", "a\0 b\0c\n\0d"]
    for _ in range(300):
        words = ["".join(draw.choices("abXé\0\0.,'1", k=draw.randint(1, 5))) for _ in range(draw.randint(1, 12))]
        texts += [" ".join(words), "".join(word + draw.choice([" ", " ", "  ", "\n", "\t"]) for word in words)]
    encoder, library = tokens.Encoder(tokenizer()), Tokenizer.from_file(tokenizer())
    expected = [found.ids for found in library.encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in encoder.encode(texts)] == expected and expected[0] == [64, 220, 188, 65]


def test_encoder_looks_up_each_distinct_part_once_however_often_it_stands(monkeypatch):
    from tokenizers import Tokenizer

    asked = []
    numbers = tokens.Encoder._numbers
    monkeypatch.setattr(tokens.Encoder, "_numbers", lambda self, parts: (asked.append(len(parts)), numbers(self, parts))[1])
    words = [f"{word}{mark}" for word in ("one", "two", "thrée", "4th", "-") for mark in ("", ",", ".", "!?")]
    texts = [" ".join(words * 20)] * 50
    found = tokens.Encoder(tokenizer()).encode(texts)
    expected = Tokenizer.from_file(tokenizer()).encode(texts[0], add_special_tokens=False).ids
    assert all(ids.tolist() == expected for ids in found)
    # The distinct pieces, and one head a text, of 20,000 pieces.
    assert sum(asked) <= len(words) + len(texts)
