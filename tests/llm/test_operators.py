"""The ten corpus operators against brute force on small tables with nulls, ties, repeated rows and odd texts."""

from __future__ import annotations

import random
import time
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from accountlens.llm import (chat, components, decontamination, mixing, pii, quality_rules, sharding, simhash,
                             token_binary, token_counts, toxicity)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, fail_bits string, seed long"
WORDS = "the of and inning ranth oner thea éle ñado stere lyan whou".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", ".\n"]) for _ in range(n))


def rows(n=60, seed=1):
    """Documents with a hot source, null cells, empty, blank and long texts, repeated rows and clashing column names."""
    rng = random.Random(seed)
    out = [(i, prose(rng, rng.randint(1, 80)), "en", "hot" if i % 2 else f"s{i % 5}", 1, "x", "y", 9) for i in range(n)]
    out += [(n, None, None, None, None, None, None, None), (n + 1, "", "en", None, 0, "x", "y", 9),
            (n + 2, " \n\t ", "en", "", 0, "x", "y", 9), (None, "a text without id", "en", "hot", 1, "x", "y", 9),
            (n + 3, prose(rng, 5000), "en", "hot", 1, "x", "y", 9), (n + 4, "q" * 30_000, "en", "hot", 1, "x", "y", 9)]
    return out + out[:3]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def as_bag(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


# token counts

def greedy(pieces, word):
    count = 0
    while word:
        size = next((k for k in range(len(word), 0, -1) if word[:k] in pieces), 0)
        if not size:
            return 1
        word, count = word[size:], count + 1
    return count


def test_automaton_counts_like_greedy_longest_match():
    rng = random.Random(3)
    for _ in range(60):
        pieces = {bytes(rng.choice(b"ab ") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 12))}
        machine = token_counts.Automaton(pieces)
        for _ in range(60):
            word = bytes(rng.choice(b"ab ") for _ in range(rng.randint(0, 12)))
            assert machine.count(word) == greedy(pieces, word), (pieces, word)


def test_token_counts_of_a_table(docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    pieces = set(token_counts.read_pieces(path))
    expected = Counter()
    for r in rows():
        words = (r[1] or "").encode().split()
        expected[(r[0], len(words), sum(greedy(pieces, b" " + w) if len(w) < 99 else token_counts.load(path).count(b" " + w)
                                        for w in words), sum(map(len, words)))] += 1
    assert as_bag(token_counts.token_counts(docs, path), "doc_id", "n_words", "n_pieces", "n_word_bytes") == expected
    assert token_counts.token_counts(empty, path).count() == 0


# sharding

@pytest.mark.parametrize("bucket_rows", [7, 8192])
def test_shards_follow_the_fractional_ranks(docs, bucket_rows):
    placed = sharding.assign_shards(docs, shards=5, bucket_rows=bucket_rows).collect()
    assert len(placed) == len(rows())
    sizes = Counter(r["shard"] for r in placed)
    assert set(sizes) == set(range(5)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r["slot"] for r in placed if r["shard"] == s) == list(range(n))
    by_source = defaultdict(list)
    for r in placed:
        by_source[r["source"]].append(r["shard"])
    for shards in by_source.values():  # each shard has its part of every source, up to rounding
        part = len(shards) / 5
        assert all(abs(shards.count(s) - part) <= 2 for s in range(5))


def test_shards_do_not_depend_on_bucket_size(docs):
    a, b = (as_bag(sharding.assign_shards(docs, bucket_rows=k), "doc_id", "text", "shard", "slot") for k in (5, 1000))
    assert {k[:1] + k[2:] for k in a} == {k[:1] + k[2:] for k in b}


def test_shards_of_nothing(empty):
    assert sharding.assign_shards(empty).count() == 0


# quality rules

def slow_repeat(words):
    at = defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i:i + 8])].append(i)
    return len({i + k for v in at.values() if len(v) > 1 for i in v for k in range(8)})


def test_repeated_windows_like_brute_force():
    rng = random.Random(5)
    for _ in range(200):
        words = [rng.choice("abc") for _ in range(rng.randint(0, 40))]
        assert quality_rules.measure(" ".join(words))[4] == slow_repeat(words)


def test_measures_by_hand():
    m = dict(zip(quality_rules.MEASURES, quality_rules.measure("Äb  C#\n\nx\vé\x1cf\nx\nx\n Äb  C#")))
    assert m == {"n_words": 8, "word_chars": 14, "n_symbols": 2, "n_dup_lines": 1, "n_repeat_words": 0, "n_lines": 5,
                 "n_stutter": 1, "n_upper": 2}
    assert quality_rules.measure(None) == (0,) * 8


def test_ledger_policies_and_ablations(docs, empty):
    kept = quality_rules.ledger(docs).cache()
    assert kept.count() == len(rows())
    for r in kept.collect():
        assert bool(r["fail_bits"] & 1) == (r["n_words"] < 20)
        assert bool(r["fail_bits"] & 2) == (100 * r["n_repeat_words"] > 30 * r["n_words"])
    bits = [r["fail_bits"] for r in kept.collect()]
    for r in quality_rules.ablations(kept).collect():
        mask, bit = quality_rules.POLICIES[r["policy"]], quality_rules.BIT[r["rule"]]
        assert r["fails"] == sum(bool(b & mask & bit) for b in bits)
        assert r["rejects_alone"] == sum(b & mask == bit for b in bits)
        assert r["kept_without"] == sum(b & mask & ~bit == 0 for b in bits)
    assert quality_rules.ledger(empty).count() == 0


def test_filter_keeps_columns_and_rows_that_pass(docs):
    good = quality_rules.filter_documents(docs)
    assert good.columns == docs.columns
    assert good.count() == quality_rules.ledger(docs).where("fail_bits = 0").count()


# personal data

def test_base_spans_by_hand():
    text = ("mail a.b@c-d.example.org, 1.2.3.4 and 999.1.1.1 1.2.3.4.5 card 4111 1111-1111 1111 or 4111111111111112 "
            "call +1 (743) 555-3824. x@y @z q@r.s@t.u")
    found = [(pii.KINDS[s.kind], text[s.start:s.end]) for s in pii.base_spans(text)]
    assert found == [("email", "a.b@c-d.example.org"), ("email", "q@r.s"), ("ip", "1.2.3.4"), ("ip", "1.2.3.4"),
                     ("card", "4111 1111-1111 1111"), ("phone", "+1 (743) 555-3824")]


def test_base_spans_of_long_runs_end():
    for text in ("9" * 200_000, "a" * 200_000 + "@", "+1" + " " * 100_000, "1." * 100_000, "x@" * 100_000):
        pii.base_spans(text)


@pytest.fixture(scope="module")
def field():
    rng = random.Random(7)
    texts = []
    for i in range(300):
        ip, tel = ".".join(str(rng.randint(1, 255)) for _ in range(4)), f"{rng.randint(100, 999)}-{rng.randint(1000, 9999)}"
        mail = f"{rng.choice(WORDS[:7])}.{rng.randint(1, 99)}@mail{rng.randint(1, 9)}.example.com"
        texts.append(f"the {ip} of version {rng.randint(1, 9)}.0. and +1 ({rng.randint(100, 999)}) {tel} ran {mail} to {ip} "
                     f"key=ab12cd{rng.randint(10, 99)}ef and {tel} {mail}.")
    return pii.fit(texts)


def test_field_adds_distant_mentions_and_nothing_else(field):
    text = "write to bob.42@mail8.example.com or +1 (743) 555-3824 today. later bob.42(at)mail8.example.com and 743-555-3824!"
    base = pii.base_spans(text)
    assert {text[s.start:s.end] for s in pii.added_spans(text, base, field)} == {"bob.42(at)mail8.example.com", "743-555-3824"}
    clean = "version 743-555-3824 and key=ab12cd34ef, 4.0. and 1234567"
    assert pii.added_spans(clean, pii.base_spans(clean), field) == []


@pytest.mark.parametrize("text, expected", [
    ("write to jane.doe@example.com now. later jane.doe(at)example.com and jane.doe[at]example[.]com, meet (at) noon",
     {"jane.doe(at)example.com", "jane.doe[at]example[.]com"}),
    ("call +1 743 555 3824 today or 743-555-3824, later 743 555 3824! not 743 555 9999", {"743-555-3824", "743 555 3824"}),
    ("host 8.8.8.8 and then 8[.]8[.]8[.]8 but 8.8.8", {"8[.]8[.]8[.]8"})])
def test_field_adds_masked_spaced_and_short_repeats(field, text, expected):
    base = pii.base_spans(text)
    assert {text[s.start:s.end] for s in pii.added_spans(text, base, field)} == expected


def test_field_links_cards_written_with_spaces():
    card = "4111 1111 1111 1111"
    other = pii.fit([f"the card 5500 0000 0000 {k:04} or 4111 1111 1111 1111 and version {k}.0 of 10.0.0.{k}" for k in range(200)])
    text = f"card {card} and later 4111/1111/1111/1111 not 4111/1111/1111/2222"
    base = pii.base_spans(text)
    g = pii.graph(text, base)
    assert [text[a:b] for a, b in g.spans][:2] == [card, "4111/1111/1111/1111"] and pii._linked_labels(g) == {1: {3}}
    assert {text[s.start:s.end] for s in pii.added_spans(text, base, other)} == {"4111/1111/1111/1111"}


def test_marginals_equal_enumeration_on_a_tree(field):
    text = "see +1 (743) 555-3824 and 743-555-3824 so"
    g = pii.graph(text, pii.base_spans(text))
    p = pii.marginals(g, field)
    free = [i for i, y in enumerate(g.observed) if not y]
    weight = defaultdict(float)
    for y in range(pii.LABELS):
        labels = g.observed.copy()
        labels[free] = y
        s = sum(g.features[i] @ field.unary[:, labels[i]] for i in free)
        s += sum(field.chain[labels[i], labels[j]] for i, j in g.chain) + sum(field.skip[labels[i], labels[j]] for i, j in g.skip)
        weight[y] = s
    w = np.exp(np.array([weight[y] for y in range(pii.LABELS)]) - max(weight.values()))
    assert len(free) == 1 and np.allclose(p[free[0]], w / w.sum(), atol=1e-3)


def test_personal_data_of_a_table(docs, empty, field):
    assert pii.find_personal_data(docs, field).where("spans <> '' or n_email + n_ip + n_card + n_phone > 0").count() == 0
    assert pii.find_personal_data(docs, field).count() == len(rows())
    assert pii.find_personal_data(empty).count() == 0


def test_rows_with_the_operators_own_column_names(spark):
    """Columns called like the operators' helpers come through, and a rule that alone rejects is named."""
    extra = ["__measures__", "__ledger", "__before", "__position", "__part", "__key", "__words", "__tie"]
    df = spark.createDataFrame([(i, "good words of a text " * 8 if i % 2 else "$ # " * 30 + f"w{i}", "s", *range(len(extra))) for i in range(20)],
                               "doc_id long, text string, source string, " + ", ".join(f"`{c}` int" for c in extra))
    kept = quality_rules.filter_documents(df.withColumn("text", F.concat("text", F.col("doc_id").cast("string"))), "base")
    assert kept.columns == df.columns
    sharded = sharding.assign_shards(df, 4)
    assert sharded.columns == df.columns + ["shard", "slot"] and all(r["__position"] == 3 and r["__before"] == 2 for r in sharded.collect())
    ledger = quality_rules.ledger(df).withColumn("by", quality_rules.rejected_alone_by(F.col("fail_bits")))
    for r in ledger.collect():
        failing = [n for n, b in quality_rules.BIT.items() if r["fail_bits"] & quality_rules.POLICIES["v3"] & b]
        assert r["by"] == (failing[0] if len(failing) == 1 else None)


# decontamination

def test_masks_lose_no_window():
    for errors in combinations(range(decontamination.WINDOW), decontamination.WINDOW - decontamination.LEAST):
        assert any(not {at + p for p in mask} & set(errors) for mask in decontamination.MASKS
                   for at in range(decontamination.WINDOW - decontamination.SPAN + 1))


def slow_leaks(texts, items):
    """From the definition: no window leaves a text; short items stand there whole."""
    out = {}
    for d, text in texts:
        words = (text or "").lower().split()
        for i, item in items:
            other = (item or "").lower().split()
            size = min(len(other), 13)
            if size < 5:
                continue
            for start in range(len(words) - size + 1):
                for s in range(len(other) - size + 1):
                    n = sum(words[start + k] == other[s + k] for k in range(size))
                    if n >= (11 if size == 13 else size):
                        have = out.get((d, i), (0, start, start + size - 1))
                        out[d, i] = (max(have[0], n), min(have[1], start), max(have[2], start + size - 1))
    return {(*k, *v) for k, v in out.items()}


@pytest.mark.parametrize("broadcast", [True, False])
def test_repeated_words_and_long_texts_leak_in_linear_time(spark, broadcast, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_PLACES", 10**6 if broadcast else 0)
    items = spark.createDataFrame([(1, "the " * 60), (2, " ".join(f"x{i}" for i in range(30))), (3, "a short question of six words")],
                                  "item_id long, text string")
    rng = random.Random(5)
    long = " ".join(f"w{rng.randrange(50_000)}" for _ in range(300_000))
    texts = [(1, "the " * 20_000), (2, long + " " + " ".join(f"x{i}" for i in range(30))), (3, "the " * 12), (4, "x0 " + "the " * 13),
             (5, "so: a SHORT question of six words"), (6, "a short question of six"), (7, " ".join(f"x{i}" for i in range(12)))]
    start = time.time()
    got = {tuple(r) for r in decontamination.leaks(spark.createDataFrame(texts, "doc_id long, text string"), items).collect()}
    assert got == {(1, 1, 13, 0, 19_999), (2, 2, 13, 300_000 - 2, 300_029), (4, 1, 13, 0, 13), (5, 3, 6, 1, 6)} - {(2, 2, 13, 299_998, 300_029)} | {
        (2, 2, 13, min(g[3] for g in got if g[0] == 2), max(g[4] for g in got if g[0] == 2))}
    assert all(g[3] >= 299_998 and g[4] <= 300_029 for g in got if g[0] == 2)
    assert time.time() - start < 60


@pytest.mark.parametrize("broadcast", [True, False])
def test_leaks_like_brute_force(spark, broadcast, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_PLACES", 10**6 if broadcast else 0)
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    items = [(i, " ".join(word() for _ in range(rng.randint(5, 30)))) for i in range(8)] + [(8, None), (None, "too short")]
    items += [(9, "a b a b " * 6), (10, "so so so so so so")]
    texts = []
    for d in range(40):
        words = [word() for _ in range(rng.randint(0, 40))]
        source = rng.choice(items[:8])[1].split()
        part = source[:rng.randint(8, 30)] if d % 2 else source[-rng.randint(8, 30):]
        for _ in range(rng.randint(0, 4)):
            part[rng.randrange(len(part))] = word().upper()
        at = rng.randint(0, len(words))
        texts.append((d, " ".join(words[:at]) + " \n" + " ".join(part).title() + "\t" + " ".join(words[at:])))
    texts += [(80, "a b " * 30), (81, "so " * 9), (82, "b a " * 6), (90, None), (91, ""), (92, items[0][1]), (92, items[1][1])]
    found = decontamination.leaks(spark.createDataFrame(texts, "doc_id long, text string"),
                                  spark.createDataFrame(items, "item_id long, text string"))
    got = {tuple(r) for r in found.collect()}
    assert {g for g in got if g[0] < 92} == {g for g in slow_leaks(texts, items) if g[0] < 92}
    assert any(g[0] < 40 for g in got) and {g[0] for g in got} >= {92}


def test_remove_leaks_by_row(docs, spark, empty):
    item = " ".join(f"w{i}" for i in range(20))
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    dirty = docs.limit(1).withColumns({"text": F.lit("x " + item), "doc_id": F.lit(None).cast("long")})
    both = docs.unionByName(dirty)
    left = decontamination.remove_leaks(both, items)
    assert left.columns == docs.columns and as_bag(left, "doc_id", "text") == as_bag(docs, "doc_id", "text")
    assert decontamination.leaks(empty, items).count() == 0
    assert decontamination.leaks(docs, items.limit(0)).count() == 0


# chat

def slow_rotations(turns, piece=1024):
    out = Counter()
    by = defaultdict(set)
    for c, t, role, text in turns:
        by[c].add((t, (role or "unknown").replace("<|", "< |"), (text or "").replace("<|", "< |")))
    for c, said in by.items():
        for p in {s for _, s, _ in said if s != "system"}:
            pieces = defaultdict(list)
            for t, s, x in sorted(said, key=lambda y: (y[0] is not None, y[0] or 0, y[1], y[2])):
                pieces[-1 if t is None else t // piece].append((s, x))
            at = 0
            for k in sorted(pieces):
                text, spans = "", []
                for s, x in pieces[k]:
                    text += "<|assistant|>\n" if s == p else "<|system|>\n" if s == "system" else f"<|user name={s}|>\n"
                    if s == p:
                        spans.append((len(text), len(text) + len(x) + 8))
                    text += x + "<|end|>\n"
                out[c, p, k, at, len(pieces[k]), text, tuple(spans)] += 1
                at += len(text)
    return out


def test_rotations_like_brute_force(spark):
    rng = random.Random(13)
    turns = [(c, t, rng.choice(["user", "assistant", "ana", "<|bob"]), f"é {rng.random()}\n<|end|>")
             for c in range(6) for t in range(rng.randint(1, 9))]
    turns += [(1, 0, "system", "be kind"), (9, 0, "system", "alone"), (2, None, "ana", None), (None, 3, None, "x"),
              (2, 1, "ana", "tie"), (2, 1, "ana", "tie"), (2, 1, "ana", "other")]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("piece", F.lit(7))
    for piece in (3, 1024):
        got = Counter((r["conv_id"], r["participant"], r["piece"], r["starts_at"], r["n_turns"], r["rendered"],
                       tuple(map(tuple, r["spans"]))) for r in chat.rotations(table, piece).collect())
        assert got == slow_rotations(turns, piece)
    assert chat.rotations(table.limit(0)).count() == 0


# near duplicates

def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    """prints: (id, fingerprint); the least id reachable of each fingerprint."""
    seen = sorted({p for _, p in prints})
    head = {p: p for p in seen}

    def find(p):
        while head[p] != p:
            p = head[p]
        return p

    for a, b in combinations(seen, 2):
        if (a ^ b).bit_count() <= 3:
            head[find(a)] = find(b)
    least = {}
    for i, p in prints:
        if i is not None:
            least[find(p)] = min(i, least.get(find(p), i))
    return {p: least.get(find(p)) for p in seen}


def test_fingerprints(spark, docs):
    for r in rows():
        if r[1] is None or len(r[1]) < 9000:
            assert simhash.fingerprint(r[1]) == slow_fingerprint(r[1])
    assert spark.range(1).select(F.xxhash64(F.lit("é b c"))).first()[0] % 2**64 == xxhash.xxh64_intdigest("é b c".encode(), 42)


def test_ball_hashing_finds_every_component(spark):
    rng = random.Random(17)
    prints = []
    for _ in range(25):
        p = rng.getrandbits(64)
        for _ in range(rng.randint(1, 8)):  # chains of 0 to 5 flipped bits: some link, some do not
            prints.append(p)
            for b in rng.sample(range(64), rng.randint(0, 5)):
                p ^= 1 << b
    ids = list(enumerate(prints)) + [(None, prints[0]), (None, 12345)]
    signed = [(i, p - 2**64 if p >> 63 else p) for i, p in ids]
    table = spark.createDataFrame(signed, "doc_id long, fp long")
    expected = slow_components(ids)
    got = {r["fp"] % 2**64: r["c"] for r in simhash._components(table, F.col("doc_id"), "c").collect()}
    assert got == expected


def test_near_duplicates_of_a_table(spark, docs, empty):
    found = simhash.near_duplicates(docs)
    prints = [(r[0], simhash.fingerprint(r[1])) for r in rows()]
    expected = slow_components(prints)
    assert Counter((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in found.collect()) == Counter(
        (i, p, expected[p]) for i, p in prints)
    left = simhash.deduplicate(docs)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] for r in left.collect()), key=str) == sorted(set(expected.values()), key=str)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.deduplicate(empty).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 150)] + [(7, 7), (200, 199)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{k: 100 for k in range(100, 150)}, 199: 199, 200: 199}


# mixing

@pytest.mark.parametrize("share", [{"a": 1}, {"a": 7, "b": 2, "c": 1}, {"a": 333, "b": 333, "c": 334}, dict.fromkeys("abcdefghij", 3)])
def test_period_stays_within_one_block(share):
    served, total = mixing.period(share), sum(share.values())
    for t in range(1, total + 1):
        for k, a in share.items():
            assert abs(served[:t].count(k) - t * a / total) < 1


@pytest.mark.parametrize("weights", [None, {"hot": 5.0, "s0": 1.0, None: 2.0}])
def test_mix_of_a_table(docs, weights):
    mixed = mixing.mix(docs, weights, block_rows=2, bucket_rows=9).collect()
    assert Counter((r["doc_id"], r["text"]) for r in mixed) == Counter((r[0], r[1]) for r in rows())
    blocks = defaultdict(list)
    for r in mixed:
        blocks[r["slot"]].append((r["phase"], r["source"], r["in_block"]))
    assert sorted(blocks) == list(range(len(blocks)))
    for b in blocks.values():
        assert sorted(x[2] for x in b) == list(range(len(b))) and len({x[0] for x in b}) == 1
    if weights is None:
        sizes = Counter(r[3] for r in rows())
        target = {k: n ** mixing.TEMPERATURE for k, n in sizes.items()}
        share = mixing.shares({str(k): w for k, w in target.items()})
        order = [blocks[s][0] for s in sorted(blocks) if blocks[s][0][0] == 0]
        for t in range(1, len(order) + 1):
            for k in sizes:
                part = t * share[str(k)] / sum(share.values())
                assert abs(sum(o[1] == k for o in order[:t]) - part) < 1


def fluid(blocks, weights, slots):
    """The blocks of each source that unrounded weights fill in so many slots."""
    low, high = 0.0, max(b / w for b, w in zip(blocks, weights))
    for _ in range(200):
        v = (low + high) / 2
        low, high = (v, high) if sum(min(b, w * v) for b, w in zip(blocks, weights)) < slots else (low, v)
    return [min(b, w * high) for b, w in zip(blocks, weights)]


@pytest.mark.parametrize("n", [10_000, 3_000_000])
@pytest.mark.parametrize("parts", [[1 / k for k in range(1, 21)], [9.5] + [1.0] * 19, [1 / k for k in range(1, 401)]])
def test_schedule_stays_within_one_block_of_unrounded_weights(n, parts):
    sizes = {f"s{k:03}": max(1, int(n * p / sum(parts))) for k, p in enumerate(parts)}
    weights = {k: m ** 0.7 for k, m in sizes.items()}
    blocks = {k: -(-m // 64) for k, m in sizes.items()}
    served, total = Counter(), sum(weights.values())
    for t, (k, j, phase) in enumerate(mixing.schedule(blocks, weights)):
        part = weights[k] / total
        assert j == served[k]
        if not phase:  # a source is furthest behind before it is served, and furthest ahead after
            assert t * part - j < 1 + 1e-6 and j + 1 - (t + 1) * part < 1 + 1e-6
        served[k] += 1
        if t % max(1, sum(blocks.values()) // 50) == 0:
            reached = fluid(list(blocks.values()), list(weights.values()), t + 1)
            assert all(abs(served[s] - x) < 1 + 1e-6 for s, x in zip(blocks, reached))
    assert served == Counter(blocks)


def test_any_number_of_sources_keeps_its_own_weight(spark):
    rows = spark.range(2_000).selectExpr("id as doc_id", "if(id < 700, id, 700 + id % 30) as source")
    sizes = mixing.source_sizes(rows)
    assert len(sizes) == 730 and mixing.POOL not in sizes
    blocks = defaultdict(set)
    for r in mixing.mix(rows, block_rows=1).collect():
        blocks[f"={r['source']}"].add((r["slot"], r["phase"]))
    total = sum(n ** mixing.TEMPERATURE for n in sizes.values())
    assert sum(map(len, blocks.values())) == 2_000
    for k, found in blocks.items():
        slots = sorted(t for t, phase in found if phase == 0)
        for j, t in enumerate(slots):
            part = sizes[k] ** mixing.TEMPERATURE / total
            assert t * part - j < 1 + 1e-6 and j + 1 - (t + 1) * part < 1 + 1e-6


def test_mix_of_nothing(empty):
    assert mixing.mix(empty).count() == 0


# toxicity

def slow_kernel(a, b):
    def weights(s):
        out = Counter()
        symbols = [toxicity._codes([c], 1)[0, 0] for c in s]
        for i, j, k in combinations(range(len(s)), 3):
            if k - i < toxicity.SPAN and toxicity.GAP not in (symbols[i], symbols[j], symbols[k]):
                out[symbols[i], symbols[j], symbols[k]] += toxicity.LAMBDA ** (k - i + 1)
        scale = sum(toxicity.LAMBDA ** (2 * (k - i + 1)) for i, j, k in combinations(range(len(s)), 3)
                    if k - i < toxicity.SPAN and toxicity.GAP not in (symbols[i], symbols[j], symbols[k]))
        return out, scale ** 0.5 if scale else 1.0
    (x, p), (y, q) = weights(a), weights(b)
    return sum(w * y[u] for u, w in x.items()) / (p * q)


def test_kernel_by_definition():
    words = ["idiot", "i.d.i.o.t", "idixot", "the", "of", "", "ñandú", "thoughtlessness", "12345"]
    got = toxicity.kernel_sums(words, toxicity.feature_table(words))
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert got[i, j] == pytest.approx(slow_kernel(a, b), abs=1e-4)
    assert got[0, 1] > 0.8 and got[0, 2] > 0.5 > got[0, 7]


def sentences(rng, toxic):
    words = [rng.choice(WORDS) + rng.choice(["", "ing", "er", "."]) for _ in range(rng.randint(5, 60))]
    if toxic:
        words.insert(rng.randint(0, len(words)), rng.choice(["idiot", "moron", "worthless"]))
    return " ".join(words)


def test_learns_insults_and_tolerates_gaps():
    rng = random.Random(19)
    texts = [(sentences(rng, y), y) for y in [0, 0, 1] * 150]
    model = toxicity.fit(*map(list, zip(*texts)))
    score = lambda t: float(model.probability(np.array([max(model.strings(sorted(toxicity.units(t)) or [""]))]))[0])
    for bad in ("you idiot here", "you i.d.i.o.t here", "you idxiot", "so m o r o n of", "wor-thless"):
        assert score(bad) > score("the ranth of stereing") + 0.2, bad
    held = [(sentences(rng, y), y) for y in [0, 1] * 100]
    assert sum((score(t) >= 0.7) == y for t, y in held) >= 190


def slow_windows(text):
    """Windows by definition: letters and single gaps, from a word's start to a word's end, long words in pieces."""
    line = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    words, at = [], 0
    for w in line:
        step = toxicity.UNIT // 2
        parts = range(0, max(1, len(w) - step), step) if len(w) > toxicity.UNIT else [0]
        words += [(at + i, min(at + i + toxicity.UNIT, at + len(w))) for i in parts]
        at += len(w) + 1
    joined = " ".join(line)
    return {joined[a:b] for a, _ in words for _, b in words if 2 < b - a <= toxicity.UNIT}


def test_value_of_a_text_is_that_of_its_strongest_window(monkeypatch):
    rng = random.Random(31)
    weights = np.random.default_rng(5).normal(size=toxicity.BASE ** 3).astype(np.float32) * toxicity._VALID
    model = toxicity.Model(weights, 1.0, 0.0)
    texts = [None, "", " .", "ab", "a b", "Idiot", "x" * 75 + " i  d..i o t", "\u4e00\u4e8c\u4e09 \U0001f600 ab"]
    texts += ["".join(rng.choice("abcdeé ,  .\n1") for _ in range(rng.randrange(200))) for _ in range(60)]
    want = []
    for t in texts:
        found = [w for w in slow_windows(t) if any(k - i < toxicity.SPAN for i, j, k in combinations(
            [n for n, c in enumerate(w) if c != " "], 3))]
        want.append(max(map(float, model.strings(found)), default=toxicity.EMPTY) if found else toxicity.EMPTY)
    assert model.texts(texts) == pytest.approx(want, abs=1e-4)
    monkeypatch.setattr(toxicity, "PIECE", 16)
    monkeypatch.setattr(toxicity, "CHUNK", 100)
    assert model.texts(texts) == pytest.approx(want, abs=1e-4)


def test_split_insults_are_found():
    rng = random.Random(37)
    model = toxicity.fit(*map(list, zip(*[(sentences(rng, y), y) for y in [0, 0, 1] * 150])))
    for insult in ("idiot", "id iot", "i d i o t", "i  d  i  o  t", "i. d. i. o. t.", "mo-ron", "worth less", "m o r o n"):
        planted = []
        for _ in range(50):
            words = sentences(rng, 0).split()
            words.insert(rng.randint(0, len(words)), insult)
            planted.append(" ".join(words))
        assert (model.probability(model.texts(planted)) >= 0.7).mean() >= 0.9, insult
    clean = [sentences(rng, 0) for _ in range(300)]
    assert (model.probability(model.texts(clean)) >= 0.7).mean() <= 0.02


def test_scores_of_a_table(spark, docs, empty):
    model = toxicity.fit(["you idiot", "the of and", "a moron here", "inning ranth"] * 5, [1, 0, 1, 0] * 5)
    got = toxicity.score_documents(docs, model).collect()
    assert len(got) == len(rows()) and all(0 <= r["score"] <= 1 for r in got)
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert r["predicted"] == (r["score"] >= 0.7)
    assert toxicity.score_documents(empty, model).count() == 0
    nothing = toxicity.fit([], [])
    assert toxicity.score_documents(docs, nothing).where("predicted = 1").count() == 0
    labels = spark.createDataFrame([(1, 0, 1), (2, 1, None), (None, 1, 1), (1, 0, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.training_rows(empty, labels) == []


# token ids

def test_pack_round_trip():
    rng = np.random.default_rng(23)
    for top in (1, 2, 300, 70_000, 1 << 25):
        docs = [rng.integers(0, top, rng.integers(0, 900)).astype("<u4") for _ in range(7)]
        assert all((a == b).all() and len(a) == len(b) for a, b in zip(docs, token_binary.unpack(token_binary.pack(docs))))
    assert token_binary.unpack(token_binary.pack([])) == []
    assert token_binary.unpack(token_binary.pack([np.empty(0, "<u4")]))[0].tolist() == []


def test_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    own, plain = token_binary.Encoder(path), Tokenizer.from_file(path)
    rng = random.Random(29)
    texts = ["", " ", "a  ", "x<|endoftext|> y", "a\0b c", "it's we'll  they're\n\n ok", "　x  y", "é à ü\n", "a\r\n b\tc"]
    texts += ["".join(rng.choice(" \n\t ab1.!'\x1c\x85\xa0é<|") for _ in range(rng.randint(0, 40))) for _ in range(500)]
    for t in texts:
        assert own.ids(t).tolist() == plain.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("memo,joined", [(400_000, 2000), (40, 7), (1, 1)])
def test_joined_pieces_equal_the_tokenizer(monkeypatch, memo, joined):
    """Pieces encoded in groups, with a memory that changes its generation all the time."""
    from tokenizers import Tokenizer
    monkeypatch.setattr(token_binary, "MEMO_PIECES", memo)
    monkeypatch.setattr(token_binary, "JOINED_PIECES", joined)
    path = public_tokenizers.path("byte_bpe_50k.json")
    own, plain = token_binary.Encoder(path), Tokenizer.from_file(path)
    rng = random.Random(31)
    parts = [" ", "  ", "\n", "\t", "a", "b", "the", "é", "'s", "<|endoftext|>", "12", "!!", "\u3000", "\x85", "漢字", "\u200b", "😀", "\x1c", "Ġ", "x" * 60]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + [None, ""]
    for start in range(0, len(texts), 50):
        for text, ids in zip(texts[start:start + 50], own.all_ids(texts[start:start + 50])):
            assert ids.tolist() == plain.encode(text or "", add_special_tokens=False).ids, repr(text)
    assert len(own._memo) <= memo + 50 * 30 and len(own._older) <= memo + 50 * 30


def test_repeated_pieces_are_looked_up_once_a_chunk():
    """The cost of a text's repeated words is not one look-up in Python for each."""
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    own, plain = token_binary.Encoder(path), Tokenizer.from_file(path)
    asked = []

    class Counting(dict):
        def __contains__(self, piece):
            asked.append(piece)
            return super().__contains__(piece)

        def __getitem__(self, piece):
            asked.append(piece)
            return super().__getitem__(piece)

        def get(self, piece, *default):
            asked.append(piece)
            return super().get(piece, *default)

    own._memo = Counting()
    words = [f"word{i}" for i in range(20)]
    texts = [" ".join(random.Random(i).choices(words, k=400)) + f", and\xa0é{i}." for i in range(30)] + [None, ""]
    for text, ids in zip(texts, own.all_ids(texts)):
        assert ids.tolist() == plain.encode(text or "", add_special_tokens=False).ids
    assert len(asked) < 1_000  # of 12,000 words


def test_signs_are_not_parted_inside_an_added_token(tmp_path):
    from tokenizers import AddedToken, Tokenizer
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.add_tokens([AddedToken("e.g.", normalized=False)])
    plain.save(str(tmp_path / "added.json"))
    own = token_binary.Encoder(str(tmp_path / "added.json"))
    for text in ("so e.g. one", "e.g.", "a. e.g.e.g.! b", "the end. xe.g.x"):
        assert own.ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_a_vocabulary_that_is_not_of_bytes_is_encoded_piece_by_piece(tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers
    plain = Tokenizer(models.WordLevel({"[U]": 0, "one": 1, "two": 2}, unk_token="[U]"))
    plain.pre_tokenizer = pre_tokenizers.Whitespace()
    plain.save(str(tmp_path / "words.json"))
    assert token_binary.Encoder(str(tmp_path / "words.json")).ids("one two three  two").tolist() == [1, 2, 0, 2]


@pytest.mark.parametrize("segment_ids", [50, 1 << 20])
def test_written_ids_come_back(spark, docs, empty, tmp_path, segment_ids):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    target = str(tmp_path / "ids")
    token_binary.write_token_ids(docs, target, path, segment_ids=segment_ids)
    got = token_binary.read_token_ids(spark, target, with_ids=True).orderBy("start").collect()
    expected = Counter((r[0], *plain.encode(r[1] or "", add_special_tokens=False).ids, 0) for r in rows())
    assert Counter((r["doc_id"], *r["ids"]) for r in got) == expected
    at = 0
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    token_binary.write_token_ids(empty, target + "-none", path)
    assert token_binary.read_token_ids(spark, target + "-none").count() == 0
