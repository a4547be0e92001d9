"""Pure Python checks of the kernels against plain versions."""

import base64
import random
from fractions import Fraction
from itertools import product
from math import comb

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import flow, kernel, mixing, packing, quality, repetition, splits, tokens

RANKS = tokens.read_vocabulary(tokens.VOCABULARY)


@pytest.fixture(scope="module")
def encoder():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(tokens.VOCABULARY, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab 's'tredvelm\n\t  é中́٣½1.,​\x1c", max_size=40), max_size=6))
def test_token_counts_equal_the_tokenizer(texts):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(tokens.VOCABULARY, "rb"))}
    encoder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    counter = tokens.PieceCounter(RANKS)
    got = [int(n) for cp, offs in kernel.blocks(pa.array(texts, pa.string())) for n in counter.counts(cp, offs)]
    assert got == [len(encoder.encode_ordinary(t)) for t in texts]


def test_token_counts_of_odd_batches(encoder):
    counter = tokens.PieceCounter(RANKS)
    texts = [None, "", " ", "word " * 100_000, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", None]
    got = [int(n) for cp, offs in kernel.blocks(pa.array(texts)) for n in counter.counts(cp, offs)]
    assert got == [len(encoder.encode_ordinary(t or "")) for t in texts]
    assert list(kernel.blocks(pa.array([], pa.string()))) == []


def test_segment_hashes_do_not_depend_on_place():
    cp = np.frombuffer("xabcxxabcx".encode("utf-32-le"), np.uint32)
    h = kernel.segment_hashes(cp, np.array([1, 6, 0]), np.array([4, 9, 3]))
    assert h[0] == h[1] != h[2]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["one two three four five six seven eight nine ten eleven. ", "A b c d. ", "x y z\n\n", "Ünï çode; "]), max_size=14))
def test_repeated_share_equals_the_exact_one(parts):
    text = "".join(parts)
    (out,) = [repetition.shares(cp, offs) for cp, offs in kernel.blocks(pa.array([text]))]
    assert abs(out[1][0] - repetition.exact_share(text)) < 1e-12


def test_planted_shares_are_what_is_measured():
    text = " ".join(f"w{k}" for k in range(300)) + ". " + " ".join(f"w{k}" for k in range(40, 90))
    kinds = set()
    for seed in range(60):
        made, share = repetition.planted(text, seed)
        kinds.add(repetition.label_of(share))
        assert abs(repetition.exact_share(made) - share) < 0.02
    assert kinds == {"ordinary", "repetitive"} and repetition.planted("too short", 1) is None


def test_planted_hashes_are_measured_as_the_planted_texts():
    texts = [" ".join(f"w{i}x{k}" for k in range(40 + 7 * i)) + (" " + " ".join(f"w{i}x{k}" for k in range(12)) if i % 3 else "") for i in range(40)] + ["", None, "a b"]
    cp, offs = kernel.code_points(pa.array(texts))
    hashes, doc = repetition._words(cp, offs)[2:]
    for turn in range(4):
        seeds = np.arange(len(texts)).astype(np.uint64) * np.uint64(7919) + np.uint64(turn)
        fits, share, score = repetition.planted_scores(hashes, doc, repetition._covered(hashes, doc), seeds)
        made = [repetition.planted(t or "", int(s)) for t, s in zip(texts, seeds)]
        assert fits.tolist() == [m is not None for m in made] and 20 < fits.sum() < len(texts)
        for m, x, y in zip(made, share, score):
            assert m is None or (m[1] == pytest.approx(x) and repetition.exact_share(m[0]) == pytest.approx(y))


def test_upper_bound_of_many():
    assert repetition.upper_bound(20_000_000, 1_000_000_000, 0.05) == pytest.approx(0.02 + 1.645 * (0.02 * 0.98 / 1e9) ** 0.5, abs=1e-7)


def test_repetition_of_empty_and_null():
    (out,) = [repetition.shares(cp, offs) for cp, offs in kernel.blocks(pa.array(["", None, "a"]))]
    assert [x.tolist() for x in out] == [[0, 0, 1], [0, 0, 0], [0, 0, 0], [0, 0, 0]]


@pytest.mark.parametrize("rejected,n", [(0, 10), (3, 40), (40, 40), (0, 600)])
def test_upper_bound_is_exact(rejected, n):
    p = repetition.upper_bound(rejected, n, 0.05)
    if rejected == n:
        assert p == 1
    else:
        tail = sum(comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(rejected + 1))
        assert abs(tail - 0.05) < 1e-6


def test_cutoffs_stop_at_the_first_failure_and_are_shared_out():
    counts = {"a": dict.fromkeys(repetition.CUTOFFS, 0), "b": {c: 0 if c >= 0.35 else 50 for c in repetition.CUTOFFS}, "c": {}}
    got = repetition.choose_cutoffs(counts, {"a": 2000, "b": 2000, "c": 5})
    assert got["a"] == repetition.CUTOFFS[-1] and got["b"] == 0.35 and got["c"] == float("inf")


def _brute_sainte_lague(weights, seats, caps):
    got = [0] * len(weights)
    for _ in range(seats):
        free = [i for i in range(len(weights)) if got[i] < caps[i] and weights[i] > 0]
        if not free:
            break
        best = max(free, key=lambda i: (Fraction(weights[i]) / (2 * got[i] + 1), -i))
        got[best] += 1
    return got


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 40)), min_size=1, max_size=6), st.integers(0, 80))
def test_sainte_lague_equals_the_plain_method(sources, seats):
    weights, caps = [w for w, _ in sources], [c for _, c in sources]
    assert mixing.sainte_lague(weights, seats, caps) == _brute_sainte_lague(weights, seats, caps)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=40), st.integers(50, 60))
def test_packing_holds_each_item_once_within_capacity(sizes, capacity):
    sizes = np.array(sizes, np.int64)
    order = np.argsort(-sizes, kind="stable")
    boxes = packing.fill(sizes, capacity, lambda i: np.random.default_rng(i).random(len(sizes)), order)
    assert sorted(i for b in boxes for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[b]) <= capacity for b in boxes)


def corpus_of(edges, terms, freqs):
    """The counts of the texts alone."""
    counts = np.bincount(terms.astype(np.int64) & (packing.SLOTS - 1), minlength=packing.SLOTS)
    return packing.Corpus(len(edges) - 1, freqs.sum() / max(len(edges) - 1, 1), counts)


def test_packing_cuts_only_what_exceeds_the_capacity():
    texts = ["alpha beta", "alpha beta gamma", "delta", "", "delta epsilon"]
    cp, offs = kernel.code_points(pa.array(texts))
    terms, freqs, edges = packing.term_lists(cp, offs)
    rows = list(packing.pack_shard(7, [10, 11, 12, 13, None], np.array([25, 7, 10, 0, 3]), edges, terms, freqs, 10, corpus_of(edges, terms, freqs)))
    by_doc = {}
    for box, doc, piece, first, n in rows:
        assert box >= 7 and n <= 10
        by_doc.setdefault(doc, []).append((piece, first, n))
    assert sorted(by_doc[10]) == [(0, 0, 10), (1, 10, 10), (2, 20, 5)]
    assert by_doc[11] == [(0, 0, 7)] and by_doc[12] == [(0, 0, 10)] and by_doc[13] == [(0, 0, 0)] and by_doc[None] == [(0, 0, 3)]
    box = {doc: box for box, doc, *_ in rows}
    assert box[11] == box[None]  # 7 and 3 fit exactly


def test_bm25_equals_the_formula_and_prefers_shared_rare_words():
    texts = ["the rare aardvark sleeps", "the common dog runs", "an aardvark eats the ants", "the dog and the cat", ""]
    cp, offs = kernel.code_points(pa.array(texts))
    terms, freqs, edges = packing.term_lists(cp, offs)
    scores = packing.Index(edges, terms, freqs, corpus_of(edges, terms, freqs)).scores(0)
    assert scores[2] > scores[1] and scores[2] > scores[3] and scores[4] == 0
    words = [t.split() for t in texts]
    mean = sum(map(len, words)) / 5
    for i, w in enumerate(words):
        plain = 0.0
        for x in set(words[0]):
            df, tf = sum(x in v for v in words), w.count(x)
            plain += np.log1p((5 - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / mean))
        assert scores[i] == pytest.approx(plain)


def test_every_neighbour_that_fits_is_taken_before_others():
    sizes = np.full(200, 2)
    near = np.arange(200) % 2 == 0
    boxes = packing.fill(sizes, 200, lambda i: np.where(near == near[i], 1.0, 0.0), np.arange(200))
    assert len(boxes) == 2 and all(len({bool(near[i]) for i in b}) == 1 for b in boxes)


def test_places_of_texts_with_common_words_agree():
    texts = [f"rare{i // 2} thing{i // 2} " + " ".join(f"own{i}x{k}" for k in range(5)) for i in range(400)]
    cp, offs = kernel.code_points(pa.array(texts))
    terms, freqs, edges = packing.term_lists(cp, offs)
    a, b = packing.places(edges, terms, corpus_of(edges, terms, freqs))
    same = np.mean((a[::2] == a[1::2]) & (b[::2] == b[1::2]))
    assert same > 0.95 and len(set(a.tolist())) > 150


CELLS = st.dictionaries(st.tuples(st.sampled_from("abc"), st.sampled_from("xyz")), st.tuples(st.integers(0, 9), st.integers(0, 12), st.integers(0, 6)), min_size=1)


@settings(max_examples=100, deadline=None)
@given(CELLS)
def test_flow_exposes_each_shortfall(cells):
    needs, available = {c: n for c, (n, _, _) in cells.items()}, {c: a for c, (_, a, _) in cells.items()}
    assert flow.lacking_rows(needs, available) == {c: max(0, n - available[c]) for c, n in needs.items()}


@settings(max_examples=150, deadline=None)
@given(CELLS)
def test_draw_keeps_size_floors_and_availability(cells):
    quotas, available, floors = ({c: x[k] for c, x in cells.items()} for k in range(3))
    drawn = flow.plan_draw(quotas, floors, available)
    least = {c: min(floors[c], available[c]) for c in cells}
    assert all(least[c] <= n <= available[c] for c, n in drawn.items())
    assert sum(drawn.values()) == min(sum(available.values()), max(sum(quotas.values()), sum(least.values())))
    if all(floors[c] <= quotas[c] <= available[c] for c in cells):
        assert drawn == quotas


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.tuples(st.sampled_from("abcd"), st.sampled_from("wxyz")), st.integers(0, 50), min_size=1), st.integers(0, 97), st.integers(0, 9))
def test_rounding_is_controlled(weights, size, seed):
    whole = sum(weights.values())
    shares = {c: Fraction(w * size, whole) if whole else Fraction(0) for c, w in weights.items()}
    got = flow.rounded(shares, seed)
    assert sum(got.values()) == sum(shares.values()) and all(abs(got[c] - shares[c]) < 1 for c in shares)
    for side in (0, 1):
        for name in {c[side] for c in shares}:
            exact, made = (sum(x[c] for c in shares if c[side] == name) for x in (shares, got))
            assert abs(exact - made) < 1


def test_rounding_is_right_on_average():
    shares = {("a", "x"): Fraction(1, 4), ("a", "y"): Fraction(1, 2), ("b", "x"): Fraction(7, 8), ("b", "y"): Fraction(3, 8)}
    drawn = [flow.rounded(shares, seed) for seed in range(4000)]
    assert all(abs(sum(d[c] for d in drawn) / 4000 - x) < 0.04 for c, x in shares.items())


def test_flow_is_cheapest():
    net = flow.Network()
    arcs = {(a, b): net.add(a, b, cap, cost) for a, b, cap, cost in [("s", "a", 2, 1), ("s", "b", 2, 2), ("a", "b", 1, 0), ("a", "t", 1, 3), ("b", "t", 2, 1)]}
    assert net.send("s", "t", 3) == 3
    cost = sum(net.flow(k) * c for (a, b), k in arcs.items() for x, y, _, c in [("s", "a", 2, 1), ("s", "b", 2, 2), ("a", "b", 1, 0), ("a", "t", 1, 3), ("b", "t", 2, 1)] if (a, b) == (x, y))
    costs = [
        sa + 2 * sb + 3 * at + bt
        for sa, sb, ab, at, bt in product(range(3), range(3), range(2), range(2), range(3))
        if sa + sb == 3 and sa == ab + at and sb + ab == bt
    ]
    assert cost == min(costs)


def test_stratify_keeps_shares():
    rng = random.Random(3)
    counts = np.array([[rng.randint(0, 4), rng.randint(0, 4)] for _ in range(400)], float)
    counts[counts.sum(1) == 0] = 1
    need = np.array([0.8, 0.1, 0.1])[:, None] * counts.sum(0)[None, :]
    place = splits.stratify(counts, need.copy())
    assert (place >= 0).all()
    for k, share in enumerate((0.8, 0.1, 0.1)):
        assert abs(counts[place == k].sum() / counts.sum() - share) < 0.02


def test_thin_labels_keep_shares_over_shards():
    """A label of few components in each shard goes to the splits by their shares, not to the largest in every shard."""
    share, got = np.array([0.8, 0.1, 0.1]), np.zeros(3)
    for shard in range(100):
        counts = np.ones((103, 3), int)
        counts[:, 1], counts[:, 2] = np.arange(103) < 3, np.arange(103) >= 3
        unit, label = np.nonzero(counts)
        place = splits.stratify_cells(unit, label, counts[unit, label], 103, share[:, None] * counts.sum(0)[None, :], turn=shard)
        got += np.bincount(place[:3], minlength=3)
        assert abs(np.bincount(place, minlength=3) / 103 - share).max() < 0.02
    assert abs(got / got.sum() - share).max() < 0.03


def test_bare_message():
    assert splits.bare_message("Ａ b\tSTRAẞE é") == splits.bare_message("a B strasse é")


def test_divergence_bounds():
    p = np.array([[1.0, 0.0], [0.5, 0.5]])
    d = quality.divergence(p, np.array([[0.0, 1.0], [0.5, 0.5]]))
    assert d[0, 0] == pytest.approx(1) and d[1, 1] == pytest.approx(0) and 0 < d[0, 1] < 1


PROSE = (
    "The court below held that the appeal must be dismissed, since the claimant had not shown that the contract was binding on the parties. "
    "In the absence of direct proof, the judge was not satisfied that the delay was caused by the carrier."
)


@pytest.mark.parametrize(
    "text,kind",
    [
        (PROSE, "prose"),
        ("\n".join(f"{i}.1 {PROSE}" for i in range(1, 4)), "prose"),
        (PROSE + "\n\n- oak anvils\n- Filing no. 33", "prose"),
        ("\n".join(f"- {w} no. {i * 77}" for i, w in enumerate(["Filing", "Survey", "Storage", "Appeal", "Stamp"] * 4)), "other"),
        ("\n".join(f"{i * 917};{i * 331};{i * 77}" for i in range(1, 30)), "other"),
        (base64.b64encode(bytes(range(256)) * 3).decode(), "other"),
        ("x" * 5000, "other"),
        ("\n\n".join(f"- item {i}" for i in range(40)), "other"),
        ("", None),
        (" \n ", None),
    ],
)
def test_structure(text, kind):
    out = quality._statistics(pa.array([text])).to_pylist()[0]
    other = out["list_share"] + out["table_share"] + out["junk_share"]
    if kind is None:
        assert out["profile"] is None and out["prose_share"] == other == 0
    else:
        assert (other > 0.5) == (kind == "other")


def test_statistics_of_null_and_counts():
    out = quality._statistics(pa.array([None, "One two. \nthree!"])).to_pylist()
    assert out[0]["words"] == 0 and out[0]["language"] is None
    assert out[1]["words"] == 3 and out[1]["lines"] == 2 and out[1]["mean_word_length"] == pytest.approx(11 / 3) and out[1]["terminated_lines"] == 0.5
