"""The corpus operators against plain brute-force versions, on small tables."""

import base64
import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybook.llm import (
    decontaminate,
    licenses,
    lm_score,
    near_dups,
    packing,
    pii,
    quality_rules,
    queries,
    resample,
    suffix_dups,
    textkit,
    warc,
)

SMALL = "/root/testdata/sf0.001"
SPACE = "[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def run(spark):
    """Rows of a registered query over the small tables, computed once."""
    made = {}

    def rows(name):
        if name not in made:
            made[name] = queries.registry()[name][0](spark, SMALL).collect()
        return made[name]

    return rows


@pytest.fixture(scope="module")
def texts(spark):
    return {r[0]: r[1] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet")
            .select("doc_id", "text").collect()}


def words_of(rng, n):
    return [f"w{rng.randrange(4000)}" for _ in range(n)]


def shingles(text, k=5):
    w = text.lower().split()
    return Counter(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else Counter()


def classes_by_brute_force(texts):
    grams = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(texts)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            shared = sum((grams[a] & grams[b]).values())
            joint = sum(grams[a].values()) + sum(grams[b].values()) - shared
            if joint == 0 or shared / joint >= 0.8:
                parent[root(a)] = root(b)
    groups = defaultdict(list)
    for i in ids:
        groups[root(i)].append(i)
    return {i: min(g) for g in groups.values() for i in g}


def test_near_duplicates_of_edited_texts(docs):
    rng = random.Random(5)
    texts = []
    for _ in range(12):
        base = words_of(rng, rng.randrange(30, 300))
        for edits in (0, 1, 2, 4, 8, 16):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = f"w{rng.randrange(4000)}"
            texts.append(" ".join(copy))
    got = {r.doc_id: r.class_id for r in near_dups.near_duplicates(docs(texts)).collect()}
    assert got == classes_by_brute_force(dict(enumerate(texts)))


def test_near_duplicates_of_a_large_group(docs):
    """More near copies than a block holds, and a passage that unlike texts share."""
    rng = random.Random(6)
    base, passage = words_of(rng, 120), words_of(rng, 40)
    texts = []
    for _ in range(600):
        copy = list(base)
        for _ in range(rng.randrange(3)):
            copy[rng.randrange(len(copy))] = f"w{rng.randrange(4000)}"
        texts.append(" ".join(copy))
    texts += [" ".join(passage + words_of(rng, 60)) for _ in range(300)]
    got = {r.doc_id: r.class_id for r in near_dups.near_duplicates(docs(texts)).collect()}
    assert {got[i] for i in range(600)} == {0}
    assert [got[i] for i in range(600, 900)] == list(range(600, 900))


def test_near_duplicates_query(run, texts):
    assert {r.doc_id: r.class_id for r in run("op1_near_duplicates")} == classes_by_brute_force(texts)


def test_alignment_needs_order():
    a = np.arange(100, dtype=np.uint64)
    assert near_dups.similarity(a, a) == 1
    assert near_dups.similarity(a, a[::-1].copy()) == 0
    assert near_dups.similarity(a, np.delete(a, [3, 50])) == pytest.approx(0.98)
    assert near_dups.similarity(a, a[25:]) == 0


def test_order_sketches_depend_on_order():
    rng = np.random.default_rng(1)
    marked = rng.integers(0, 1 << 63, 40).astype(np.uint64)
    same = near_dups.order_sketches(marked) == near_dups.order_sketches(marked[::-1].copy())
    assert same.mean() < 0.2
    assert (near_dups.order_sketches(marked) == near_dups.order_sketches(marked.copy())).all()


def rule_counts(text):
    w = re.findall(SPACE, text)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {
        j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)
    }
    lines = [x for x in text.split("\n") if re.search(SPACE, x)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
    )


def test_quality_rules_query(run, texts):
    for r in run("op2_quality_rules"):
        counts = rule_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        assert r.base_failed == failed
        assert not (failed and r.kept)


def test_quality_rules_follow_labels(run, spark):
    """Good means of quality and harmless; the insults listed are English."""
    rows = spark.read.parquet(f"{SMALL}/labels.parquet").collect()
    labels = {r.doc_id: r.quality == 1 and r.toxic == 0 for r in rows}
    seen = [(r.kept, labels[r.doc_id]) for r in run("op2_quality_rules") if r.doc_id in labels]
    right = sum(kept == label for kept, label in seen)
    assert right >= 0.93 * len(seen)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.sampled_from(list("abAB01 .@-+()#\n")), max_size=60).map("".join))
def test_formats_by_brute_force(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert pii.find_pii(df).first().base_sha256 == expected_spans(text)[1]


def test_near_copies_with_null_and_repeated_ids(docs):
    rng = random.Random(13)

    def edited(words, places):
        return [f"new{i}" if i in places else w for i, w in enumerate(words)]

    first, other = words_of(rng, 200), words_of(rng, 200)
    bridge = edited(first, {20, 50, 80})
    last = edited(bridge, {110, 140, 170})
    unlike = edited(other, {10, 40, 70, 100, 130, 160})
    rows = [
        (21, first), (None, bridge), (20, last),
        (1, edited(other, {190})), (9, other), (9, unlike), (2, edited(unlike, {180})),
        (None, words_of(rng, 30)),
    ]
    found = near_dups.near_duplicates(docs([(i, " ".join(w)) for i, w in rows])).collect()
    none = 0
    assert sorted((r.doc_id or none, r.class_id or none, r.is_first) for r in found) == [
        (0, 0, False), (0, 20, False), (1, 1, True), (2, 2, True), (9, 1, False), (9, 2, False),
        (20, 20, True), (21, 20, False),
    ]


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def expected_spans(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if {
                "email": lambda m=m: True,
                "ip": lambda m=m: all(int(x) <= 255 for x in m[0].split(".")),
                "card": lambda d=digits: 13 <= len(d) <= 19 and luhn(d),
                "phone": lambda d=digits: 9 <= len(d) <= 15,
            }[kind]():
                found.append(f"{kind}:{m.start()}:{m.end()}")
    return found, hashlib.sha256(",".join(found).encode()).hexdigest()


def test_personal_data_query(run, texts):
    for r in run("op3_personal_data"):
        spans, digest = expected_spans(texts[r.doc_id])
        assert r.base_sha256 == digest
        assert r.spans.split(",")[: len(spans)] == (spans or [""])[: len(spans)]


def test_formats_in_awkward_texts(docs):
    rows = [
        "a@b.c_x@y.z 1.2.3.4.5.6.7.8 999.1.1.1", "+" * 50 + "+1 (212) 555-0100",
        "4111 1111 1111 1111-", "é😀 me@x.org ü 00192.168.000.1", "1" * 50_000, "a" * 100_000 + "@",
        "+1" + "(" * 20_000,
    ]
    got = {r.doc_id: r.base_sha256 for r in pii.find_pii(docs(rows)).collect()}
    assert got == {i: expected_spans(t)[1] for i, t in enumerate(rows)}


def test_long_values_and_names_are_found_whole(docs):
    rng = random.Random(12)
    names = ["token", "AWS_SECRET_ACCESS_KEY_FOR_PRODUCTION_DB_OF_THE_REGION"]
    seeds = [f"{n} = {rng.getrandbits(160):040x} of a member" for n in names for _ in range(12)]
    values = ["Kq7" + "xYz9" * 50, "k" * 300 + "7", "ab.c-" * 400 + "9"]
    long = [f'a {n} = "{v}" here.' for n in names for v in values]
    rows = seeds + long
    found = {r.doc_id: r.spans for r in pii.find_pii(docs(rows)).collect()}
    clean = {r.doc_id: r.text for r in pii.redact(docs(rows)).collect()}
    for i, (n, v) in enumerate((n, v) for n in names for v in values):
        at = len(f'a {n} = "')
        assert found[len(seeds) + i] == f"context:{at}:{at + len(v)}"
        assert clean[len(seeds) + i] == f'a {n} = "[CONTEXT]" here.'


def test_cues_in_awkward_texts(docs):
    rows = [
        "to: token: abc123x.", "9a.x-key=a1b2c3 aa:bb=cc = d4e5f6", "aa=" * 200_000,
        "aa=" * 200_000 + "1234567", "1." * 100_000, "a-" * 100_000 + ":", "aa:" + "b.c" * 50_000,
        "aa:1" + "." * 100_000,
    ]
    got = docs(rows).select("doc_id", pii.cue_values(F.col("text")).alias("c")).collect()
    found = {r.doc_id: [(c.pattern, c.start, c.end) for c in r.c] for r in got}
    assert found[0] == [("token :", 11, 18)]
    assert found[1] == [("x-key =", 9, 15), ("cc =", 27, 33)]
    assert found[3] == [("aa =", 3, 600_007)]
    assert not any(found[i] for i in (2, 4, 5, 6, 7))


def test_contexts_find_unseen_identifiers(docs):
    rng = random.Random(2)
    seeds = [f"badge = {rng.getrandbits(160):040x} of a member" for _ in range(12)]
    unseen = ["badge = ZX-77-1234 of a guest", "size = 12345678 of a hall", "room: 4th-floor-b"]
    got = {r.doc_id: r.spans for r in pii.find_pii(docs(seeds + unseen)).collect()}
    assert got[12] == "context:8:18"
    assert got[13] == got[14] == ""
    clean = {r.doc_id: r.text for r in pii.redact(docs(seeds + unseen)).collect()}
    assert clean[12] == "badge = [CONTEXT] of a guest"
    assert clean[13] == unseen[1]


def test_leaks_found_wherever_they_start(docs, frame):
    rng = random.Random(3)
    items = [(i, " ".join(words_of(rng, n))) for i, n in enumerate((5, 9, 11, 16, 40, 59, 90))]
    rows, want = [], set()
    for i, text in items:
        for before in range(9):
            want.add((len(rows), i))
            rows.append(" ".join([*words_of(rng, before), text.upper() + "!", *words_of(rng, 5)]))
    rows += [" ".join(words_of(rng, 200)) for _ in range(30)]
    bench = frame(items, "item_id bigint, text string")
    found = decontaminate.find_leaks(docs(rows), bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want
    assert all(r.first_word == r.doc_id % 9 and r.similarity == 1 for r in found)
    left = {r.doc_id for r in decontaminate.drop_leaks(docs(rows), bench).collect()}
    assert left == set(range(len(rows))) - {d for d, _ in want}


def test_edited_leak_is_verified_exactly(docs, frame):
    rng = random.Random(4)
    item = words_of(rng, 60)
    edited = [*item[:2], "changed", *item[3:]]
    half = [*item[:30], *words_of(rng, 30)]
    bench = frame([(7, " ".join(item))], "item_id bigint, text string")
    found = decontaminate.find_leaks(docs([" ".join(edited), " ".join(half)]), bench).collect()
    assert [(r.doc_id, r.item_id) for r in found] == [(0, 7)]
    assert 0.8 <= found[0].similarity < 1


def test_edited_headless_and_long_leaks_by_brute_force(docs, frame):
    rng = random.Random(11)
    sizes = (5, 7, 9, 12, 20, 40, 90, 250, 300, 450)
    items = [(i, words_of(rng, n)) for i, n in enumerate(sizes)]
    items.append((len(items), words_of(rng, 6) * 5))  # shingles that repeat
    rows = []
    for _, item in items:
        n = len(item)
        for kind in range(8):
            copy = list(item)
            if kind % 4 == 0:  # no head
                copy = copy[max(n // 12, 1) :]
            elif kind % 4 == 1:  # edited all over
                for at in range(kind, n, 24 + kind * 3):
                    copy[at] = "edited"
            elif kind % 4 == 2:  # words left out and put in, early in the item
                del copy[n // 6 : n // 6 + max(n // 40, 1)]
                copy[n // 4 : n // 4] = words_of(rng, max(n // 40, 1))
            else:  # one block unlike, behind the first 256 words of long ones
                low = min(n * 2 // 3, n - 1)
                copy[low : low + n // 14] = words_of(rng, n // 14)
            rows.append(words_of(rng, rng.randrange(30)) + copy + words_of(rng, rng.randrange(30)))

    def weights(words):
        out = Counter()
        for i in range(len(words) - 4):
            out[tuple(words[i : i + 5])] += sum(map(len, words[i : i + 5]))
        return out

    want = {}
    for d, words in enumerate(rows):
        for i, item in items:
            own = weights(item)
            total = sum(own.values())
            best = (0.0, 0)
            for at in range(len(words) - 4):
                place = weights(words[at : at + len(item)])
                both = sum((own & place).values())
                best = max(best, (both / (total + sum(place.values()) - both), -at))
            if best[0] >= 0.8:
                want[d, i] = (-best[1], best[0])
    assert len(want) > 30
    assert len({i for _, i in want}) > 6
    bench = frame([(i, " ".join(w)) for i, w in items], "item_id bigint, text string")
    found = decontaminate.find_leaks(docs([" ".join(w) for w in rows]), bench).collect()
    assert {(r.doc_id, r.item_id): (r.first_word, r.similarity) for r in found} == want


def test_multi_index_misses_none_in_radius():
    rng = np.random.default_rng(3)
    index = decontaminate.ItemIndex([(i, " ".join(words_of(random.Random(i), 20))) for i in range(40)])
    key = next(iter(index.by_size))
    own = index.by_size[key][0]
    flips = np.zeros(len(own), np.uint64)
    for _ in range(decontaminate.RADIUS):
        flips |= np.uint64(1) << rng.integers(0, 64, len(own)).astype(np.uint64)
    prints = np.concatenate([own ^ flips, rng.integers(0, 1 << 63, 500).astype(np.uint64)])
    got = set(zip(*(x.tolist() for x in index.within_radius(key, prints)), strict=True))
    near = np.bitwise_count(prints[:, None] ^ own[None, :]) <= decontaminate.RADIUS
    assert got == set(zip(*(x.tolist() for x in np.nonzero(near)), strict=True))


def test_leaks_query(run, texts, spark):
    def plain(text):
        return " " + " ".join(re.findall(r"[a-z0-9\x80-\U0010ffff]+", text.lower())) + " "

    items = [(r.item_id, plain(r.text)) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    want = {(d, i) for d, t in texts.items() for p in [plain(t)] for i, b in items if b in p}
    assert want <= {(r.doc_id, r.item_id) for r in run("op4_benchmark_leaks")}


@pytest.mark.parametrize("k", [0, 1, 7, 500, 999, 1000, 5000])
def test_top_k_is_exact(spark, k):
    rng = random.Random(9)
    values = [rng.choice([rng.gauss(0, 50), 3.25, -1e9]) for _ in range(1000)]
    rows = spark.createDataFrame(list(enumerate(values)), "doc_id bigint, key double")
    got = {r.doc_id for r in resample.top_k(rows, "key", ["doc_id"], k).collect()}
    want = sorted(range(1000), key=lambda i: (-values[i], i))[:k]
    assert got == set(want)


def test_resampling_prefers_the_target(docs, frame):
    rng = random.Random(1)
    good = [" ".join(words_of(rng, 80)) for _ in range(300)]
    bad = [" ".join([*words_of(rng, 40), *["rotten"] * 20]) for _ in range(100)]
    labels = [(i, 1, 0) for i in range(150)] + [(i, 1, 1) for i in range(300, 350)]
    drawn = resample.resample(
        docs(good + bad), frame(labels, "doc_id bigint, quality int, toxic int")
    ).collect()
    assert len(drawn) == 300
    assert sum(r.doc_id >= 300 for r in drawn) <= 3


def test_resampling_query_on_held_out_labels(spark):
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")
    labels = read("labels")
    drawn = resample.resample(read("documents"), labels.where("doc_id % 2 = 0"))
    held = labels.where("doc_id % 2 = 1").join(drawn.select("doc_id", "key"), "doc_id", "left")
    rates = {
        (r.good): r.rate
        for r in held.selectExpr("quality = 1 and toxic = 0 as good", "int(key is not null) as k")
        .groupBy("good").agg({"k": "avg"}).withColumnRenamed("avg(k)", "rate").collect()
    }
    assert rates[True] > 0.8
    assert rates[True] > rates[False] + 0.3


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=12))
def test_shortest_pack_first(counts):
    slots = packing.shortest_pack_first(counts, 64)
    used, places = Counter(), defaultdict(list)
    for length, rank, count, sequence, offset in slots.tolist():
        used[length] += count
        assert rank >= 0
        for i in range(count):
            places[sequence + i].append((offset, length))
    assert used == Counter(counts)
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64


def test_pack_query(run, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    ids = {
        d: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for d, t in texts.items()
    }
    rows = run("op6_pack_sequences")
    seen, sequences = Counter(), defaultdict(list)
    for r in rows:
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4")
        assert (r.doc_tokens, r.ids_crc32) == (len(ids[r.doc_id]), zlib.crc32(part.tobytes()))
        seen[r.doc_id] += len(part)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert seen == Counter({d: len(i) for d, i in ids.items()})
    for parts in sequences.values():
        assert sum(n for _, n in parts) <= 4096
        assert all(o == sum(n for p, n in parts if p < o) for o, _ in parts)
    assert sum(seen.values()) / len(sequences) > 0.85 * 4096


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9)), max_size=9))
def test_loser_tree(runs):
    runs = [sorted(r) for r in runs]
    assert list(warc.LoserTree(runs, lambda x: x)) == list(heapq.merge(*runs))


def test_archives_query(run, spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    groups = defaultdict(list)
    for p in pages:
        groups[p.html or ""].append(p.page_id)
    want = set()
    for p in pages:
        raw, top = (p.html or "").encode(), max(groups[p.html or ""])
        kind = "response" if p.page_id == top else "revisit"
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want.add((p.page_id, len(raw), digest, kind, None if kind == "response" else top))
    rows = run("op7_web_archives")
    assert {tuple(r)[:5] for r in rows} == want
    keys = [(r.url_key, r.captured_at, r.page_id) for r in rows]
    assert keys == sorted(keys)


def test_archives_query_against_sql(run):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SMALL}/pages.parquet'")
    want = con.sql(queries.registry()["op7_web_archives"][1])
    rows = run("op7_web_archives")
    assert want.columns == list(rows[0].__fields__)
    assert sorted(want.fetchall()) == sorted(map(tuple, rows))


def repeats_by_brute_force(texts, n):
    times = Counter(t[i : i + n] for t in texts for i in range(len(t) - n + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - n + 1):
            if times[t[i : i + n]] > 1:
                gone[i : i + n] = [True] * n
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats_by_brute_force(docs, monkeypatch):
    rng = random.Random(8)
    letters = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    base, passage = letters(3000), letters(500)
    rows = [base, base[:700] + "X" + base[701:], base[100:499] + letters(50), passage + letters(300)]
    rows += [letters(rng.randrange(300)) + passage + letters(rng.randrange(300)) for _ in range(60)]
    rows += ["z" * 1500, "ab" * 400, "short", letters(600) * 2, base[5:405], letters(10) + base[5:404]]
    want = repeats_by_brute_force([t.encode() for t in rows], 400)
    for limit in (suffix_dups.SORTED_CONTEXTS, 3):
        monkeypatch.setattr(suffix_dups, "SORTED_CONTEXTS", limit)
        got = {r.doc_id: tuple(r)[1:] for r in suffix_dups.remove_repeats(docs(rows)).collect()}
        assert [got[i] for i in range(len(rows))] == want


@pytest.mark.parametrize("paired", [0, 24])
def test_suffix_sort_matches_bytes(monkeypatch, paired):
    monkeypatch.setattr(suffix_dups, "PAIRED_CONTEXTS", paired)
    rng = random.Random(12)
    core = bytes(rng.choice(b"ab") for _ in range(1200))
    raws = [bytes(rng.choice(b"ab") for _ in range(k)) + core[k : k + 500] for k in range(60, 160, 5)]
    made = [[suffix_dups.Context(r, 200, 100) for r in raws] for _ in range(2)]
    suffix_dups.repeated_starts(made[0])
    suffix_dups._by_bytes(made[1])
    assert [(c.low, c.high) for c in made[0]] == [(c.low, c.high) for c in made[1]]
    assert any(c.high >= 0 for c in made[0])


def test_repeats_query(run, texts):
    ids = sorted(texts)
    got = {r.doc_id: tuple(r)[1:] for r in run("op8_repeated_strings")}
    assert [got[i] for i in ids] == repeats_by_brute_force([texts[i].encode() for i in ids], 400)


def test_unbroken_repeats_are_one_row(docs):
    """A piece repeated without a break is no frequent key: one row a text, with its places."""
    rng = random.Random(31)
    letters = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    run = "Is onhe. " * 150
    rows = [letters(rng.randrange(200)) + run[k:] + letters(rng.randrange(600)) for k in range(12)]
    rows += ["Ab, cd. " * 90, letters(500), letters(30) + ("x" * 99 + "y") * 6]
    rows.append(letters(450) + "x" * 401)
    lengths = [len(t.encode()) for t in rows]
    found = suffix_dups.find_anchors(*textkit.buffer_of(pa.array(rows)))
    for row, size in enumerate(lengths):  # the rows' strings start everywhere, and in order
        here = np.flatnonzero(found["row"] == row)
        ends = found["stop"][here] - 400
        assert found["low"][here].tolist() == [0, *(ends[:-1] + 1).tolist()]
        assert ends[-1] == size - 400
    hot = Counter()
    for one, times in zip(found["one"].tolist(), found["times"].tolist(), strict=True):
        hot[one] += times
    frequent, places = hot.most_common(1)[0]
    assert places > 1000 and (found["one"] == frequent).sum() <= 12
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dups.remove_repeats(docs(rows)).collect()}
    want = repeats_by_brute_force([t.encode() for t in rows], 400)
    assert [got[i] for i in range(len(rows))] == want


def test_scores_by_brute_force():
    rng = np.random.default_rng(4)
    vocabulary = lm_score.Vocabulary.of(rng.integers(0, 50, 1 << 14).astype(float))
    net = lm_score.Network.start(np.ones(lm_score.CLASSES))
    texts = pa.array(["a b c d e f", None, "", "one", "x y z " * 900])
    columns = [pa.array(range(5)), pa.array(range(5)), texts]
    batch = pa.RecordBatch.from_arrays(columns, ["doc_id", "mark", "text"])
    hashed = next(lm_score._hashed([batch]))
    got = next(lm_score._score([hashed], vocabulary, net.flat)).to_pydict()
    embed, hidden, weight, out = net.parts()
    for r, text in enumerate(texts.to_pylist()):
        buckets = np.array(hashed.column("words")[r].as_py(), np.int32).view(np.uint32) % (1 << 14)
        ids = vocabulary.classes[buckets].tolist()
        total = 0.0
        for i, c in enumerate(ids):
            h = hidden.astype(float).copy()
            for j, step in enumerate(lm_score.AROUND):
                near = ids[i + step] if 0 <= i + step < len(ids) else lm_score.EDGE
                h += embed[j * (lm_score.CLASSES + 1) + near]
            z = np.tanh(h) @ weight + out
            total += z[c] - np.log(np.exp(z).sum()) + vocabulary.inner[buckets[i]]
        assert got["n_words"][r] == len(ids)
        assert got["log_likelihood"][r] == pytest.approx(total, rel=1e-4, abs=1e-4)


def test_lm_score_steps_see_only_their_places_and_share_memory():
    """Contexts are made for a step's targets alone, and scores beyond the bound stay bounded."""
    rng = np.random.default_rng(11)
    classes, first = rng.integers(0, 256, 200), np.array([0, 0, 1, 3, 80, 200, 200])
    whole = lm_score.contexts(classes, first)
    for i in range(200):  # by brute force
        text = int(np.searchsorted(first, i, side="right")) - 1
        for j, step in enumerate(lm_score.AROUND):
            inside = first[text] <= i + step < first[text + 1]
            expected = classes[i + step] if inside else lm_score.EDGE
            assert whole[i, j] == expected + j * (lm_score.CLASSES + 1)
    padded, places = lm_score.spread(classes, first)
    pick = np.arange(3, 200, 8)
    assert (lm_score.around(padded, places[pick]) == whole[pick]).all()

    net = lm_score.Network.start(rng.integers(1, 99, 256).astype(float))
    room = np.full((200, lm_score.CLASSES), np.nan, np.float32)  # what an earlier step left there
    for size in (1, 40):  # scores within the bound, and beyond it
        net.flat *= np.float32(size)
        g = net.gradient(whole[pick], classes[pick], room)
        assert (g == net.gradient(whole[pick], classes[pick])).all() and np.isfinite(g).all()
        logp = net.forward(whole[pick])[1][np.arange(len(pick)), classes[pick]]
        assert net.of_targets(whole[pick], classes[pick], room) == pytest.approx(logp, abs=1e-4)


def test_gradient_by_differences():
    rng = np.random.default_rng(2)
    net = lm_score.Network.start(np.ones(lm_score.CLASSES))
    net.flat = net.flat.astype(np.float64)
    context = lm_score.contexts(rng.integers(0, 256, 30), np.array([0, 10, 30]))
    target = rng.integers(0, 256, 30)
    loss = lambda: -net.forward(context)[1][np.arange(30), target].mean()
    g = net.gradient(context, target)
    for at in [*rng.integers(0, len(net.flat), 10), int(context[3, 1]) * lm_score.WIDTH + 2, -3]:
        old = net.flat[at]
        net.flat[at] = old + 1e-5
        up = loss()
        net.flat[at] = old - 1e-5
        assert g[at] == pytest.approx((up - loss()) / 2e-5, abs=1e-4)
        net.flat[at] = old


def test_training_beats_class_shares(docs):
    rng = random.Random(7)
    text = lambda: " ".join(f"a{k} b{k}" for k in (rng.randrange(40) for _ in range(400)))
    vocabulary, net = lm_score.train(lm_score.keep_words(docs([text() for _ in range(1500)])))
    words, _, _, first = textkit.word_hashes(*textkit.buffer_of(pa.array([text()])), lm_score._TABLE)
    buckets = (words >> np.uint64(32)).astype(np.uint32) % np.uint32(len(vocabulary.classes))
    classes = vocabulary.classes[buckets].astype(int)
    logp = net.forward(lm_score.contexts(classes, first))[1][np.arange(len(classes)), classes]
    share = np.bincount(classes, minlength=lm_score.CLASSES) / len(classes)
    assert logp.mean() > np.log(share[classes]).mean() + 0.5


def test_licenses_by_brute_force(docs):
    rng = random.Random(11)
    names = list(licenses.TEMPLATES)
    rows, want = [], set()
    for k, name in enumerate(names * 3):
        want.add((len(rows), name))
        around = words_of(rng, rng.randrange(60)), words_of(rng, rng.randrange(60))
        rows.append(" ".join([*around[0], licenses.TEMPLATES[name].upper(), *around[1]]))
        half = licenses.TEMPLATES[names[k % len(names)]].split()
        rows.append(" ".join(half[: len(half) // 2]))
    found = licenses.find_licenses(docs(rows)).collect()
    assert {(r.doc_id, r.license) for r in found} == want
    assert all(r.containment == 1 for r in found)


def test_licenses_query(run, texts):
    def plain(text):
        return " " + " ".join(w for w in re.split(r"[^\w]+|_", text.lower()) if w) + " "

    want = {
        (d, name)
        for d, t in texts.items()
        for p in [plain(t)]
        for name, template in licenses.TEMPLATES.items()
        if plain(template) in p
    }
    assert {(r.doc_id, r.license) for r in run("op10_license_scan")} == want


def _thue_morse(n):
    text = "a"
    while len(text) < n:
        text += text.translate(str.maketrans("ab", "ba"))
    return text


@pytest.mark.parametrize("size", [1024, 2048, 4096])
def test_words_that_share_a_hash_keep_their_own_ids(size):
    first = _thue_morse(size)
    second = first.translate(str.maketrans("ab", "ba"))
    words = packing.WordIds(queries.tokenizer_path())
    together = [f"{first} x {second}", f"y {second}", f"{first}", "plain words"]
    for texts in (together, [second, first]):  # within a block, and against a remembered word
        got = dict(words.encode(pa.array(texts)))
        for i, text in enumerate(texts):
            want = words.tokenizer.encode(text, add_special_tokens=False).ids
            assert got[i].tolist() == want


def test_unequal_spans():
    a = np.frombuffer(b"abcdefabcxef", np.uint8)
    at, size = np.array([0, 6, 0, 3]), np.array([3, 3, 6, 1])
    ref, ref_size = np.array([6, 6, 6, 9]), np.array([3, 2, 6, 1])
    assert packing.unequal(a, at, size, a, ref, ref_size).tolist() == [False, True, True, True]


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "GROUP_WORDS", 20_000)
    monkeypatch.setattr(lm_score, "CHUNK_WORDS", 3_000)
    rng = random.Random(5)
    texts = [" ".join(f"w{int(rng.paretovariate(0.7)) % 999}" for _ in range(rng.randrange(300))) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    one, six = (
        {r.doc_id: r.log_likelihood for r in lm_score.score(df.repartition(n)).collect()} for n in (1, 6)
    )
    assert one.keys() == six.keys() == set(range(600))
    for i in one:
        assert one[i] == pytest.approx(six[i], rel=1e-6, abs=1e-6)


def test_every_word_is_a_target_once(monkeypatch):
    seen = []
    monkeypatch.setattr(lm_score.Network, "gradient", lambda net, around, target: seen.append(target) or 0 * net.flat)
    vocabulary = lm_score.Vocabulary.of(np.arange(1 << 14, dtype=float))
    words = pa.array(list(range(1000)), pa.int32())
    batch = pa.RecordBatch.from_arrays(
        [pa.array([0] * 10, pa.int64()), pa.ListArray.from_arrays(pa.array(range(0, 1001, 100), pa.int32()), words)],
        ["group", "words"],
    )
    flat = lm_score.Network.start(np.ones(lm_score.CLASSES)).flat
    for phases in (range(0, 4), range(4, 8)):
        list(lm_score._train([batch], vocabulary, flat, phases))
    assert sorted(np.concatenate(seen).tolist()) == sorted(vocabulary.classes[:1000].tolist())


def test_the_vocabulary_grows():
    sizes = [lm_score.n_buckets(n) for n in (0, 10**6, 10**8, 10**9, 10**12)]
    assert sizes == sorted(sizes) and sizes[0] == 1 << 14 and sizes[2] < sizes[3] <= sizes[4] == 1 << 22


def test_harmful_texts_go_though_they_are_well_written(spark):
    good = "The committee met on Monday, and its members agreed on a plan for the next year. "
    rude = "You are a pathetic loser, a worthless clown and a disgusting moron. "
    rows = [(i, good * (3 + i % 5)) for i in range(400)]
    rows += [(1000 + i, good * (2 + i % 3) + rude) for i in range(40)]
    rows += [(2000, good * 40 + "What a stupid idea.")]
    df = spark.createDataFrame([(i, f"Text {i}. {t}") for i, t in rows], "doc_id bigint, text string")
    rules = [r for r in quality_rules.RULES if r.name != "repeats"]
    p = {r.doc_id: r.p_good for r in quality_rules.apply_rules(df, rules).collect()}
    assert all(p[i] < 0.5 for i in p if 1000 <= i < 2000)
    assert all(p[i] >= 0.5 for i in p if i < 1000 or i == 2000)


def test_the_share_of_good_documents_is_not_bounded(spark):
    rng = random.Random(3)
    junk = ["".join(rng.choices("#*$%&|", k=6)) + f" {i} @@ !! ??" for i in range(1900)]
    fine = [f"This is a plain line of text about thing number {i}, and nothing else." for i in range(100)]
    df = spark.createDataFrame(list(enumerate(junk + fine)), "doc_id bigint, text string")
    voted = quality_rules.votes(quality_rules.measures(df))
    assert quality_rules.fit(voted).prior < 0.2
