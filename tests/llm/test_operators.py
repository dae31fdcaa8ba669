"""Each operator against a plain version, on the given tables and on rows that are hard."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

from tests.conftest import SF
from tidemark.llm.components import components
from tidemark.llm.decontamination import contaminated
from tidemark.llm.packing import pack
from tidemark.llm.quality_classifier import classify
from tidemark.llm.quality_rules import repetition
from tidemark.llm.queries import QUERIES
from tidemark.llm.sharding import shard
from tidemark.llm.simhash import simhash_groups
from tidemark.llm.substring_dedup import dedup
from tidemark.llm.suffix_dedup import suffix_dedup
from tidemark.llm.token_files import read_token_files, write_token_files
from tidemark.llm.tokens import default_tokenizer
from tidemark.llm.warc import read_archives, write_archives
from tidemark.session import work_dir

SHORT = "one two three"
LINE = " ".join(f"word{i}" for i in range(60))
LONG = " ".join(f"{'äöü' if i % 7 else 'x'}{i * i % 977}" for i in range(30_000))
HARD = [
    (1, None), (2, ""), (3, " \t\n "), (4, SHORT), (4, SHORT), (5, LINE), (6, "lead " + LINE + " end"), (7, LINE),
    (8, LONG), (9, "start " + LONG[5000:30_000]), (10, "spam " * 400), (11, "a" * 5000), (12, "ä" * 700 + "a" * 300),
    (None, LINE), (None, None), (13, "line one is here\n" * 30), (14, "über  straße x\x1cy <|endoftext|> z\x00w"),
    (15, "ONE TWO THREE"), (16, "x\r\ny\x0bz\x0cq"), (2**40, "far " + LINE), (17, "\n\n" + LINE + "\n\n" + LINE),
    (18, "🙂" * 120 + LINE), (19, "🙂" * 119 + "🙃" + LINE),
]
CLASHES = {c: "int" for c in ("chunk", "part", "size", "shard", "fp", "packet", "key", "salt", "h", "t", "at", "own_id", "row", "group")}


@pytest.fixture(scope="module")
def hard(spark):
    names = ", ".join(f"{c} {t}" for c, t in CLASHES.items())
    return spark.createDataFrame([(*r, *[7] * len(CLASHES)) for r in HARD], f"doc_id long, text string, {names}").repartition(3)


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(params=["hard", "given", "empty"])
def docs(request, hard, given):
    return {"hard": hard, "given": given, "empty": hard.limit(0)}[request.param]


def rows_of(docs):
    """(doc_id, text) in the order of operators that have one: null first, then by text."""
    got = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    return sorted(got, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", text.encode())


def test_substring_dedup(docs):
    want, seen = Counter(), set()
    for doc_id, text in rows_of(docs):
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            own = tuple(w[k : k + 20])
            if own in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(own)
        want[doc_id, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()] += 1
    out = dedup(docs)
    assert bag(out.select("doc_id", "n_words", "n_removed", "text")) == want
    assert all(r["n_removed"] == sum(s["end"] - s["first"] for s in r["removed"]) for r in out.collect())


def test_substring_dedup_with_other_blocks(spark, hard):
    with pytest.raises(ValueError):
        dedup(hard, window=20, block=11)
    a = bag(dedup(hard, window=9, block=5).select("doc_id", "text"))
    assert a == bag(dedup(hard, window=9, block=3).select("doc_id", "text"))


def repeats(texts, width):
    count = Counter(t[k : k + width] for t in texts for k in range(len(t) - width + 1))
    out = []
    for t in texts:
        gone, end = bytearray(len(t)), 0
        for k in range(len(t) - width + 1):
            if count[t[k : k + width]] > 1:
                gone[max(end, k) : k + width] = b"\1" * (k + width - max(end, k))
                end = k + width
        out.append(gone)
    return out


def test_suffix_dedup(docs):
    rows = rows_of(docs)
    raw = [t.encode() for _, t in rows]
    want = Counter()
    for (doc_id, _), t, gone in zip(rows, raw, repeats(raw, 200)):
        spans = sum(1 for j in range(len(t)) if gone[j] and (j == 0 or not gone[j - 1]))
        want[doc_id, len(t), sum(gone), spans, bytes(x for x, g in zip(t, gone) if not g)] += 1
    got = suffix_dedup(docs, memory=1 << 14)
    assert Counter((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()) == want


def test_suffix_dedup_keeps_whole_characters(hard):
    for r in suffix_dedup(hard, whole_characters=True).collect():
        bytes(r["kept"]).decode()
    assert bag(suffix_dedup(hard, width=90, gram=20).select("doc_id", "n_removed")) == bag(
        suffix_dedup(hard, width=90, gram=41).select("doc_id", "n_removed")
    )


def fingerprint(text):
    w = [x.lower() for x in words(text)]
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_groups(docs):
    rows = rows_of(docs)
    codes = [fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= 2:
                label[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(i)] = min(least.get(top(i), doc_id), doc_id)
    want = Counter((d, f"{c:016x}", least.get(top(i))) for i, ((d, _), c) in enumerate(zip(rows, codes)))
    assert bag(simhash_groups(docs)) == want


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(200, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{k: 100 for k in range(100, 160)}}


def test_quality_classifier_on_held_out_labels(spark, given):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.1')}/documents.parquet")
    labels = spark.read.parquet(f"{SF.replace('0.001', '0.1')}/labels.parquet")
    out = classify(docs, labels)
    got = out.join(labels, "doc_id").filter("held_out").collect()
    assert len(got) > 500 and np.mean([r["predicted"] == r["quality"] for r in got]) > 0.98
    good = [r["predicted"] for r in got if r["quality"] == 1]
    assert np.mean(good) > 0.995
    for r in out.limit(300).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)


def test_quality_classifier_defined_cases(spark, hard):
    for labels in ([], [(4, 1), (5, 0), (6, None), (None, 1)], [(d, int(bool(t))) for d, t in HARD]):
        out = classify(hard, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
        assert len(out) == len(HARD) and all(0 <= r["score"] <= 1 for r in out)
    assert classify(hard.limit(0), spark.createDataFrame([(4, 1)], "doc_id long, quality int")).collect() == []


def test_held_out_labels_do_not_reach_the_scores(spark, given):
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    held = lambda d: zlib.crc32(str(d).encode()) % 5 == 0
    kind = "doc_id long, quality int"
    a = spark.createDataFrame([(r["doc_id"], r["quality"]) for r in labels], kind)
    b = spark.createDataFrame([(r["doc_id"], 1 - r["quality"] if held(r["doc_id"]) else r["quality"]) for r in labels], kind)
    one, two = ({r["doc_id"]: r["score"] for r in classify(given, x).collect()} for x in (a, b))
    assert max(abs(one[k] - two[k]) for k in one) < 1e-6


QUESTION = "A train leaves Boston at 60 km per hour and reaches Denver after 12 hours how far is Denver from the start"


def test_decontamination_finds_changed_slots(spark):
    swap = lambda *pairs: __import__("functools").reduce(lambda s, p: s.replace(*p), pairs, QUESTION)
    docs = [
        (1, "noise before it " + QUESTION + " and after"), (2, swap(("60", "75"), ("Denver", "Paris"), ("12", "8"))),
        (3, "text " + swap(("from", "to")).replace("reaches Denver", "reaches Paris")), (4, "nothing of the kind is here at all in this text"),
        (5, QUESTION.upper()), (6, " ".join(QUESTION.split()[:9])), (7, None), (8, ""), (9, "Same short, item!"), (9, "other"),
        (10, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16"), (1, "noise before it " + QUESTION + " and after"), (None, QUESTION),
        (11, "x " * 20_000 + QUESTION),
    ]
    items = [(70, QUESTION), (71, None), (72, ""), (73, "same short item"), (74, "3 4 5 6 7 8 9 10 11"), (70, QUESTION)]
    out = contaminated(
        spark.createDataFrame([(*d, 1, 1) for d in docs], "doc_id long, text string, item_id int, n int"),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    got = {(r["doc_id"], r["item_id"]): (r["slots"], r["changed_slots"]) for r in out.collect()}
    assert set(got) == {(1, 70), (2, 70), (None, 70), (11, 70), (9, 73)}  # 3 gives Denver two values; 5 has no names
    assert got[1, 70][1] == 0 and got[2, 70][1] == 3 and out.count() == len(got)


def decontaminated(spark, docs, items):
    """(doc_id, item_id) of the texts and items, each numbered from 0."""
    frame = lambda rows, key: spark.createDataFrame(list(enumerate(rows)), f"{key} long, text string")
    return {(r["doc_id"], r["item_id"]) for r in contaminated(frame(docs, "doc_id"), frame(items, "item_id")).collect()}


def test_decontamination_finds_windows_of_few_words_verbatim(spark):
    sums, long = "What is 12 + 5 * 3 - 4 ?", "add up the numbers 1 2 3 4 5 6 7 8 9 10 and tell us the sum"
    docs = ["We ask you this. " + sums + " The answer is 23.", "We ask you this. What is 12 + 6 * 3 - 4 ?", " ".join(map(str, range(1, 40))),
            "now " + long + " please", "We ask you this. What is 9 + 9 * 9 - 9 ?"]
    assert decontaminated(spark, docs, [sums, long, "1 2 3 4 5 6 7 8 9 10", "add " + " ".join(map(str, range(1, 20)))]) == {(0, 0), (3, 1)}


def test_decontamination_counts_the_words_of_windows_with_gaps(spark):
    item = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(45)]
    ninth = ["other" if i % 9 == 8 else w for i, w in enumerate(item)]
    apart = [*item[:8], *["other"] * 4, *item[12:20], *["other"] * 25]
    one = [*item[:8], *["other"] * 37]
    docs = [" ".join(["begin", *d, "end"]) for d in (ninth, apart, one)]
    assert decontaminated(spark, docs, [" ".join(item)]) == {(0, 0), (1, 0)}


def test_decontamination_drops_windows_in_dispute_only(spark):
    short = "a train goes at 60 km an hour and a car goes at 60 km an hour which is the first there"
    words = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)]
    words[5] = words[50] = "60"
    altered = [*words[:50], "75", *words[51:]]
    every = " ".join("61" if w == "60" and i == 4 else "62" if w == "60" else w for i, w in enumerate(short.split()))
    docs = [short[:20] + short[20:].replace("60", "**60**"), " ".join(altered), every, short.replace("60", "75.")]
    # of 2, which gives 60 two values, the windows without 60 are left, which cover 16 words
    assert decontaminated(spark, docs, [short, " ".join(words)]) == {(0, 0), (1, 1), (2, 0), (3, 0)}
    brief = "he paid 60 for a hat and 60 for a coat"
    assert decontaminated(spark, [brief.replace("a hat and 60", "a hat and **60**"), brief.replace("and 60", "and 70")], [brief]) == {(0, 0)}


def test_decontamination_reads_sentence_starts_as_words_and_names(spark):
    asks, tom = "What is the capital city of the state?", "Tom has 5 apples. Tom buys 3 more in the shop. Ann eats one. How many are left for Tom"
    docs = ["Geography quiz\n" + asks, "quiz: what is the capital city of the state", tom.replace("Tom", "Bob").replace("5", "7"),
            "A label\n" + tom, tom.replace("Tom", "Bob", 1).replace("Ann eats", "Eve sells"), "Label Lima is the town"]
    assert decontaminated(spark, docs, [asks, tom, "What is the town"]) == {(0, 0), (1, 0), (2, 1), (3, 1)}


def test_decontamination_of_given_tables(spark, given):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    clean = lambda t: [re.sub(r"[^\w]", "", w).lower() for w in t.split()]
    found = set()
    for i in items.collect():
        w = clean(i["text"])
        for d, t in rows_of(given):
            if " ".join(w[1:13]) in " ".join(clean(t)):
                found.add((d, i["item_id"]))
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(given, items).collect()}
    assert found <= got and len(got) <= len(found) + 2
    assert contaminated(given, items.limit(0)).count() == 0 and contaminated(given.limit(0), items).count() == 0


def test_packing(docs):
    library = Tokenizer.from_file(default_tokenizer())
    want = Counter()
    for doc_id, text in rows_of(docs):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        want[doc_id, len(ids), ids.tobytes()] += 1
    full = {zlib.crc32(k[2]): k for k in want}
    out = pack(docs, default_tokenizer(), group_tokens=1 << 16).collect()
    sequences = defaultdict(list)
    for r in out:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    used = []
    for own in sequences.values():
        own.sort()
        assert [a for a, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1]]
        used.append(sum(n for _, n in own))
        assert used[-1] <= 1024
    total = sum(k[1] * n for k, n in want.items())
    assert sum(used) == total
    if total > 20_000:
        assert 1024 * len(used) < 1.03 * total
    singles = {k[0]: np.frombuffer(k[2], "<u4") for k, n in want.items() if n == 1 and sum(1 for x in want if x[0] == k[0]) == 1}
    by_doc = defaultdict(list)
    for r in out:
        by_doc[r["doc_id"]].append(r)
    for doc_id, ids in singles.items():
        own = sorted(by_doc[doc_id], key=lambda r: r["start"])
        assert [r["start"] for r in own] == [0, *np.cumsum([r["length"] for r in own])[:-1]]
        for r in own:
            assert r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    assert full or not out


def test_token_files_round_trip(spark, docs):
    library = Tokenizer.from_file(default_tokenizer())
    want, at = Counter(), 0
    for doc_id, text in rows_of(docs):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4")
        want[doc_id, at, len(ids), zlib.crc32(ids.tobytes())] += 1
        at += len(ids)
    files = write_token_files(docs, default_tokenizer(), 2, work_dir(spark, "test-tokens"), shard_tokens=4096)
    assert bag(read_token_files(files)) == want


SYMBOLS = "#*$%&|<>"


def test_quality_rules(docs):
    got = Counter()
    for r in repetition(docs).collect():
        got[tuple(r[c] for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "dup_5gram_chars"))] += 1
    want = Counter()
    for doc_id, text in rows_of(docs):
        w = [x.decode() for x in words(text)]

        def inside(n, first):
            count, mark, before = Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)), [False] * len(w), set()
            for i in range(len(w) - n + 1):
                if count[tuple(w[i : i + n])] > 1 if first else tuple(w[i : i + n]) in before:
                    mark[i : i + n] = [True] * n
                before.add(tuple(w[i : i + n]))
            return mark

        seen, dup = set(), 0
        for line in text.split("\n"):
            dup += line in seen and bool(words(line))
            seen.add(line)
        repeat = sum(inside(8, True))
        failed = len(w) < 20 or 100 * repeat > 30 * len(w)
        chars = sum(len(x) for x, m in zip(w, inside(5, False)) if m)
        want[doc_id, len(w), sum(map(len, w)), sum(c in SYMBOLS for c in text), dup, repeat, failed, chars] += 1
    assert got == want


def test_quality_rules_keep_good_documents(spark, given):
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1")
    got = repetition(given).join(labels, "doc_id").filter("not base_failed")
    assert got.filter("kept").count() >= 0.99 * got.count() > 0


def test_sharding(docs):
    out = shard(docs, cell_rows=3).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == Counter(
        (d, len(t.encode()) + 16, zlib.crc32(t.encode())) for d, t in rows_of(docs)
    )
    by_text, slots, size = defaultdict(set), defaultdict(list), Counter()
    for r in out:
        by_text[r["text_crc32"], r["size"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        size[r["shard"]] += r["size"]
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = Counter()
    for r in out:
        groups[r["text_crc32"], r["size"]] += r["size"]
    if len(groups) > 40:
        alone = sorted(groups.values())[-1]
        assert set(size) == set(range(40)) and max(size.values()) <= max(alone, 1.05 * sum(size.values()) / 40)


def test_archives_round_trip(spark):
    pages = [
        (5, "http://a/ b\r\nX: y", "same"), (3, "http://c", "same"), (9, None, "same"), (1, "u", None), (2, "u", ""), (4, "ü", "<p>ü\r\n\r\nWARC/1.1</p>"),
        (7, "v", "x" * 300_000), (7, "v", "x" * 300_000), (None, "n", "same"), (None, "n", "only"),
    ]
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, key int")
    files = write_archives(df, work_dir(spark, "test-warc"), archive_bytes=1000)
    out = read_archives(files, with_payload=True).collect()
    sha = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    first = {}
    for p, _, t in pages:
        if p is not None:
            first[t or ""] = min(p, first.get(t or "", p))
    want = Counter()
    for p, _, t in pages:
        f = first.get(t or "")
        again = f is not None and f != p
        want[p, len((t or "").encode()), sha(t), "revisit" if again else "response", f if again else None] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out) == want
    assert all(bytes(r["payload"]) for r in out if r["record_type"] == "response" and r["payload_bytes"])
    assert write_archives(df.limit(0), work_dir(spark, "test-warc")).count() == 0


def test_archives_of_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    first = {}
    for p in sorted(pages, key=lambda p: p["page_id"]):
        first.setdefault(p["html"] or "", p["page_id"])
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in QUERIES["op7_warc"](spark, SF).collect()}
    assert got == {
        p["page_id"]: ("response", None) if first[p["html"] or ""] == p["page_id"] else ("revisit", first[p["html"] or ""]) for p in pages
    }


def test_words_with_one_polynomial_hash_are_two_words(spark):
    from tests.llm.test_parts import TWINS

    rest = " ".join(f"w{i}" for i in range(19))
    docs = spark.createDataFrame([(1, f"{TWINS[0]} {rest}"), (2, f"{TWINS[1]} {rest}")], "doc_id long, text string")
    assert [r["n_removed"] for r in dedup(docs).collect()] == [0, 0]
    seven = " ".join(f"w{i}" for i in range(7))
    text = f"{TWINS[0]} {seven} x1 x2 x3 x4 x5 x6 x7 x8 {TWINS[1]} {seven} y1 y2"
    row = repetition(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["n_repeat_words"] == 0 and not row["base_failed"]
