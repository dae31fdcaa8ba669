"""The parts of the operators that need no session."""

from __future__ import annotations

import io
import tempfile
import zipfile
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import warc
from tidemark.llm.common import Words, utf8
from tidemark.llm.hashsets import pack, ranges, unpack
from tidemark.llm.packing import differencing, windows
from tidemark.llm.quality_classifier import isotonic, statistics
from tidemark.llm.sharding import Tree, place
from tidemark.llm.simhash import BKTree, links_in
from tidemark.llm.suffix_dedup import repeated, sliding_least
from tidemark.llm.suffix_sort import DiskQueue, SuffixSorter, repeated_prefixes
from tidemark.llm.token_files import TokenFile, WaveletMatrix, pack_file
from tidemark.llm.tokens import Encoder, default_tokenizer, with_end


@given(st.lists(st.text(alphabet=st.sampled_from("ab \t\n\x1cäé🙂\x00"), max_size=40), max_size=6), st.integers(1, 9))
@settings(max_examples=200, deadline=None)
def test_words_are_those_of_bytes(texts, block):
    offsets, data = utf8(pa.array(texts, pa.string()))
    got = Words(offsets, data, block)
    raw = data.tobytes()
    want = [t.encode().split() for t in texts]
    assert [raw[a:b] for a, b in zip(got.start, got.end)] == [w for t in want for w in t]
    assert got.counts.tolist() == [len(t) for t in want]
    same = {}
    for h, a, b in zip(got.hash.tolist(), got.start, got.end):
        assert same.setdefault(h, raw[a:b]) == raw[a:b]
    assert len(same) == len({w for t in want for w in t}) == len(set(got.second.tolist()))


@given(st.lists(st.integers(0, 2**64 - 1), max_size=50), st.integers(1, 9))
def test_hash_sets_round_trip(values, count):
    own = np.unique(np.array(values, np.uint64))
    parts = ranges(own, count)
    assert [v for _, a, b in parts for v in unpack(pack(own[a:b])).tolist()] == own.tolist()


@given(st.lists(st.integers(1, 3), min_size=1, max_size=150), st.integers(1, 12), st.booleans())
@settings(max_examples=300, deadline=None)
def test_suffixes_are_sorted_with_common_prefixes(symbols, cap, spill):
    text = np.array([*symbols, 0], np.uint8)
    folder = tempfile.mkdtemp() if spill else None
    sorter = SuffixSorter(text, cap, 24 if spill else 1 << 30, folder)
    parts = list(sorter.neighbours())
    raw = text.tobytes()
    order = np.concatenate([p for p, _ in parts])[::-1].tolist()
    assert sorted(order) == list(range(len(text)))
    own = [raw[i : i + cap] for i in order]
    assert own == sorted(own)
    common = np.concatenate([c for _, c in parts]).tolist()
    down = own[::-1]
    for k in range(1, len(down)):
        n = next((i for i, (x, y) in enumerate(zip(down[k - 1], down[k])) if x != y), min(len(down[k - 1]), len(down[k])))
        if down[k - 1][0] == down[k][0]:
            assert common[k] == n or (n < cap and common[k] >= n and b"\0" in down[k][: n + 1])
    count = Counter(raw[i : i + cap] for i in range(len(raw) - cap))
    want = [count[raw[i : i + cap]] > 1 for i in range(len(raw) - cap)]
    assert repeated_prefixes(text, cap, 24 if spill else 1 << 30, folder)[: max(0, len(raw) - cap)].tolist() == want


def test_the_queue_goes_to_disk_and_back(tmp_path):
    queue = DiskQueue(64, str(tmp_path))
    for k in range(20):
        queue.push(k % 3, np.arange(k, k + 5), np.full(5, k, np.uint16))
    assert queue.files and list(tmp_path.iterdir())
    at, common = queue.pop(1)
    assert at.tolist() == [x for k in range(1, 20, 3) for x in range(k, k + 5)] and common[5] == 4
    queue.pop(0), queue.pop(2)
    assert not list(tmp_path.iterdir())


@pytest.mark.parametrize("alphabet", [range(256), range(1, 4)])
def test_passages_of_all_bytes(alphabet):
    rng = np.random.default_rng(3)
    own = [rng.choice(list(alphabet), 60).astype(np.uint8).tobytes() for _ in range(8)]
    own[3] = own[5][10:50] + own[3]
    own = list(dict.fromkeys(own))
    count = Counter(p[i : i + 12] for p in own for i in range(len(p) - 11))
    for p, got in zip(own, repeated(own, [False] * len(own), 12, 1 << 20, None)):
        assert got.tolist() == [count[p[i : i + 12]] > 1 for i in range(len(p) - 11)]


@given(st.lists(st.integers(0, 9), min_size=1, max_size=40), st.integers(1, 12))
def test_sliding_least(values, w):
    got = sliding_least(np.array(values, np.uint64), w).tolist()
    assert got == [min(values[i : i + w]) for i in range(len(values) - w + 1)]


@given(st.lists(st.integers(0, 2**16 - 1), max_size=80, unique=True), st.integers(0, 4))
def test_bk_tree_finds_all_within_the_radius(codes, radius):
    tree = BKTree()
    for c in codes:
        tree.add(c)
    for q in codes[:5] + [0, 77]:
        assert {codes[i] for i in tree.search(q, radius)} == {c for c in codes if (c ^ q).bit_count() <= radius}


@given(st.lists(st.integers(0, 2**12 - 1), max_size=120, unique=True))
@settings(deadline=None)
def test_split_shards_join_the_same(codes):
    def groups(links):
        of = list(range(len(codes)))
        for i, j in links:
            a, b = of[i], of[j]
            of = [a if x == b else x for x in of]
        return {frozenset(k for k in range(len(codes)) if of[k] == v) for v in of}

    pairs = [(i, j) for i in range(len(codes)) for j in range(i) if (codes[i] ^ codes[j]).bit_count() <= 2]
    free = list(range(12))
    assert groups(pairs) == groups(links_in(codes, free, 2)) == groups(links_in(codes, free, 2, largest=4))


@given(st.lists(st.integers(1, 100), min_size=1, max_size=40), st.integers(1, 9))
def test_differencing_uses_every_window_number_once(sizes, ways):
    to = differencing(sizes, ways)
    assert len(to) == len(sizes) and set(to) <= set(range(ways))
    loads = np.bincount(to, weights=sizes, minlength=ways)
    assert loads.max() - loads.min() <= max(sizes)


def test_differencing_of_two_ways_is_the_known_example():
    loads = np.bincount(differencing([8, 7, 6, 5, 4], 2), weights=[8, 7, 6, 5, 4])
    assert abs(loads[0] - loads[1]) == 2


@given(st.lists(st.integers(1, 128), max_size=60))
def test_windows_hold_their_capacity(sizes):
    to = windows(sizes, 128) if sizes else []
    if sizes:
        assert np.bincount(to, weights=sizes).max() <= 128


@given(st.lists(st.integers(0, 60_000), max_size=1300), st.integers(0, 60_000))
@settings(deadline=None, max_examples=60)
def test_wavelet_matrix(ids, other):
    ids = np.array(ids, np.uint32)
    raw = pack_file(ids, np.array([len(ids)]), [None], 16)
    file = TokenFile(raw)
    matrix = file.matrix
    assert file.doc_ids == [None] and matrix.decode().tolist() == ids.tolist()
    at = np.arange(len(ids))
    assert matrix.access(at).tolist() == ids.tolist()
    for token in {other, *ids[:3].tolist()}:
        lo, hi = len(ids) // 4, len(ids) - len(ids) // 5
        where = [i for i in range(lo, hi) if ids[i] == token]
        assert matrix.count(token, lo, hi) == len(where) and matrix.places(token, lo, hi).tolist() == where


def test_wavelet_matrix_of_wide_ids():
    ids = np.array([0, 70_000, 131_071, 5, 70_000], np.uint32)
    assert WaveletMatrix.of(ids, 17).decode().tolist() == ids.tolist()


# Two words of 1,024 letters that polynomial hashes modulo 2^64 can't tell apart, whatever their base.
THUE_MORSE = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
TWINS = (THUE_MORSE, THUE_MORSE.translate({97: 98, 98: 97}))
LIBRARY, OWN = Tokenizer.from_file(default_tokenizer()), Encoder(default_tokenizer(), keep=20)


@given(st.lists(st.text(max_size=60), max_size=8))
@settings(deadline=None, max_examples=150)
def test_ids_are_those_of_the_library(texts):
    library = LIBRARY
    own = Encoder(default_tokenizer(), keep=20)
    texts = [*texts, "a  b\n\n c\t\td  ", "it's  'tis  x y \x1c z\x85", "don't<|endoftext|> go", " " * 9, "é" * 30]
    texts += ["", " a", "b ", "so: 12,5% (ÄÖ÷×ü)\nx", "\n", "ab\n", "<|endoftext|>"]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [own.encode(t).tolist() for t in texts] == want
    for _ in range(2):
        ids, ends = own.encode_all(pa.array([*texts, None]))
        assert [x.tolist() for x in np.split(ids, ends)][:-2] == want
        ids, ends = with_end(ids, ends, 7)
        assert [x.tolist() for x in np.split(ids, ends)][:-1] == [[*w, 7] for w in [*want, []]]


@given(st.lists(st.text(alphabet=st.sampled_from("ab Zé÷3.,#\n'x"), max_size=25), max_size=12))
@settings(deadline=None, max_examples=150)
def test_ids_of_batches(texts):
    ids, ends = OWN.encode_all(pa.array(texts, pa.string()))
    assert [x.tolist() for x in np.split(ids, ends)][:-1] == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_are_told_apart_by_their_bytes():
    ids, ends = OWN.encode_all(pa.array(TWINS))
    assert [x.tolist() for x in np.split(ids, ends)][:-1] == [LIBRARY.encode(t, add_special_tokens=False).ids for t in TWINS]


def test_ids_of_a_long_text():
    library = LIBRARY
    text = "".join(f"word{i % 991} \n"[: 5 + i % 5] + " " * (i % 3) for i in range(300_000))
    assert Encoder(default_tokenizer()).encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


@given(st.lists(st.tuples(st.integers(1, 50), st.integers(0, 30)), max_size=60))
def test_tree_gives_the_tightest(steps):
    tree, plain = Tree(), []
    for k, (room, want) in enumerate(steps):
        tree.add(room, k)
        plain.append((room, k))
        fit = sorted(p for p in plain if p[0] >= want)
        assert tree.take_tightest(want) == (fit[0] if fit else None)
        if fit:
            plain.remove(fit[0])


def test_bins_are_near_equal_and_a_giant_is_alone():
    rng = np.random.default_rng(5)
    sizes = sorted(rng.integers(50, 200, 2000).tolist(), reverse=True)
    loads = np.bincount(place(sizes, 40), weights=sizes)
    assert len(loads) == 40 and loads.max() < 1.002 * loads.mean()
    loads = np.bincount(place([10**6, *sizes], 40), weights=[10**6, *sizes])
    assert loads[0] == 10**6 and loads[1:].max() < 1.002 * loads[1:].mean()
    assert place([], 40) == [] and place([7], 40) == [0]


@given(st.lists(st.tuples(st.floats(0, 1), st.integers(1, 5)), min_size=1, max_size=25))
def test_isotonic_rises_and_keeps_the_mean(points):
    v, w = np.array([p[0] for p in points]), np.array([p[1] for p in points], float)
    got = isotonic(v, w)
    assert (np.diff(got) >= -1e-12).all() and abs((got * w).sum() - (v * w).sum()) < 1e-9


def test_statistics_do_not_depend_on_neighbours():
    texts = ["", "one", "a b a b a b", "Ünï ### !! |", None, " \n ", "x" * 3000]
    together = statistics(pa.array(texts))
    alone = np.concatenate([statistics(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(together, alone) and np.isfinite(together).all()


@pytest.mark.parametrize("wide", [False, True])
def test_zip_directories(monkeypatch, wide):
    if wide:  # everything beyond a few bytes and members needs the 64-bit fields
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 3)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    raw = [warc.record(k, f"http://x/{k}", b"payload %d" % k, None) for k in range(50)]
    file = warc.build([(str(k), r) for k, r in enumerate(raw)])
    out = io.BytesIO(file)
    with zipfile.ZipFile(out, "a") as z:
        z.writestr("notes.txt", "packed" * 100, zipfile.ZIP_DEFLATED)
        z.comment = b"a comment with PK\x05\x06 in it"
    file, reads = out.getvalue(), []

    def read_at(at, n):
        reads.append(n)
        return file[at : at + n]

    assert (b"PK\x06\x07" in file) == wide
    reader = warc.ZipReader(read_at, len(file))
    assert set(reader.members) == {warc.DATA, warc.INDEX}  # the packed one is no stored member
    got = list(warc.read_records(read_at, len(file), run=600))
    assert [b.partition(b"\r\n\r\n")[2] for _, b in got] == [b"payload %d" % k for k in range(50)]
    with pytest.raises(ValueError):
        warc.ZipReader(lambda at, n: b"nothing"[at : at + n], 7)
