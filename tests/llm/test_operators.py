"""Each operator against a brute-force version on odd rows, on an empty table and with clashing columns."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from casemill.llm import decontaminate, mixing, near_dup, pii, quality, secrets, substrings, suffixes, token_shards, toxicity

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def sha(b):
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


def table(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def docs(frame, odd_rows, clashing):
    return clashing(frame(odd_rows)).cache()


@pytest.fixture(scope="module")
def empty(frame):
    return frame([])


@pytest.fixture(scope="module")
def labels(spark, odd_rows):
    rows = [(i, k % 2, int(k % 5 == 0)) for k, (i, _, _) in enumerate(odd_rows)]
    return spark.createDataFrame(rows + [(1, None, None), (None, 1, 1), (2, 1, None)], "doc_id bigint, quality int, toxic int")


# ------------------------------------------------------------ 3

def removed_words(rows, width=35):
    texts = [SPACE.findall(t or "") for _, t, _ in rows]
    count = Counter(tuple(w[j : j + width]) for w in texts for j in range(len(w) - width + 1))
    for (i, _, _), w in zip(rows, texts):
        gone = [False] * len(w)
        for j in range(len(w) - width + 1):
            if count[tuple(w[j : j + width])] > 1:
                gone[j : j + width] = [True] * width
        yield i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))


def test_substrings(docs, odd_rows):
    got = table(substrings.remove_repeats(docs), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == Counter(removed_words(odd_rows))


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(0)
    p = substrings.Substrings()
    names = np.concatenate([substrings.mix(rng.integers(1, 6, 4000).astype(np.uint64)), np.full(80, 7, np.uint64), np.tile(np.arange(3, dtype=np.uint64), 60)])
    starts = np.arange(len(names) - p.window + 1)
    anchor, place = substrings.anchors(names, starts, p)
    by = {}
    for s in starts:
        by.setdefault(names[s : s + p.window].tobytes(), set()).add(int(anchor[s]))
    assert all(len(v) == 1 for v in by.values())
    assert len(place) == len(starts)


# ------------------------------------------------------------ 4

def removed_bytes(rows, width=50):
    last = 1 << 63
    texts = [(last if i is None else i, (t or "").encode()) for i, t, _ in rows]
    least = {}
    for i, t in texts:
        for j in range(len(t) - width + 1):
            k = t[j : j + width]
            least[k] = min(least.get(k, last), i)
    for (d, _, _), (i, t) in zip(rows, texts):
        gone = np.zeros(len(t) + 1, bool)
        for j in range(len(t) - width + 1):
            if least[t[j : j + width]] < i:
                gone[j : j + width] = True
        spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        yield d, len(t), int(gone.sum()), spans, sha(bytes(x for x, g in zip(t, gone) if not g))


def test_suffixes(docs, odd_rows):
    got = table(suffixes.remove_earlier(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == Counter(removed_bytes(odd_rows))


@pytest.mark.parametrize("depth", [3, 12, 50])
def test_interval_expansion(depth):
    rng = np.random.default_rng(depth)
    parts = [np.append(rng.integers(1, 4, rng.integers(depth, depth + 60)), 0) for _ in range(20)]
    parts += [parts[0], np.append(np.ones(depth + 9, int), 0)]
    t = np.concatenate(parts).astype(np.int16)
    order = suffixes.suffix_order(t, depth)
    group = np.cumsum(suffixes.boundaries(t, order, depth))
    seen = {}
    for rank, at in enumerate(order):
        s = t[at : at + depth]
        if len(s) == depth and s.all():
            seen.setdefault(s.tobytes(), set()).add(int(group[rank]))
    assert all(len(v) == 1 for v in seen.values())
    assert len({min(v) for v in seen.values()}) == len(seen)


# ------------------------------------------------------------ 5

def test_decontaminate(spark, frame, clashing):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma".split()
    often = [w if k % 5 != 4 else "other" for k, w in enumerate(item)]
    half = [w if k % 2 else "other" for k, w in enumerate(item)]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, ""), (4, "too short"), (None, " ".join(item)), (5, "a b c d e f g h")],
                                  "item_id bigint, text string")
    rows = [(1, "x y " + " ".join(item) + " z", None), (2, " ".join(often), None), (3, " ".join(half), None), (4, None, None), (5, "", None),
            (6, "nothing of it here at all, only other words", None), (7, "Alpha, BETA; " + " ".join(item[2:]), "s"), (None, " ".join(item), None),
            (1, "x y " + " ".join(item) + " z", None), (8, "a b c d e f g h", None), (9, "w " * 50_000 + " ".join(item), None)]
    got = {(r["doc_id"], r["item_id"]): (r["first_word"], r["n_equal"]) for r in decontaminate.overlaps(clashing(frame(rows)), bench).collect()}
    assert set(got) == {(1, 1), (2, 1), (7, 1), (8, 5), (9, 1)}
    assert got[(1, 1)] == (2, 15) and got[(2, 1)][1] == 12 and got[(9, 1)] == (50_000, 15)
    kept = decontaminate.decontaminated(clashing(frame(rows)), bench)
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [3, 4, 5, 6, None]
    big = decontaminate.Decontaminate(broadcast_seeds=0)
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(frame(rows), bench, big).collect()} == set(got)


# ------------------------------------------------------------ 7

def test_quality_counts(docs, odd_rows):
    def brute(i, t):
        w = SPACE.findall(t or "")
        windows = Counter(tuple(w[j : j + 8]) for j in range(len(w) - 7))
        hit = {j + k for j in range(len(w) - 7) if windows[tuple(w[j : j + 8])] > 1 for k in range(8)}
        lines = [x for x in (t or "").split("\n") if SPACE.search(x)]
        return i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(hit), len(w) < 20 or 100 * len(hit) > 30 * len(w)

    got = quality.quality(docs)
    assert table(got, "doc_id", *quality.COUNTS, "base_failed") == Counter(brute(i, t) for i, t, _ in odd_rows)
    assert got.where("kept and base_failed").count() == 0


def test_boilerplate_lines(frame, clashing):
    own = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(20)]
    shared = "Subscribe to our   newsletter 2024"
    rows = [(i, f"{own[i]}\n{shared}", "h") for i in range(15)] + [(i, own[i], "h") for i in range(15, 20)]
    rows += [(30, "subscribe to our newsletter 1999\n" * 8, "h"), (31, f"{own[3]}\n{shared}", "other"), (32, "short", "h")]
    rows += [(40 + i, "one text with more than twenty words " * 1 + own[0] + " copied as it is", "copies") for i in range(30)]
    docs = clashing(frame(rows))
    verdict = quality.quality(docs)
    kept = {r["doc_id"]: r["kept"] for r in verdict.collect()}
    assert kept[30] is False and kept[32] is False
    assert all(kept[i] for i in [*range(20), 31, *range(40, 70)])
    cleaned = {r["doc_id"]: r for r in quality.without_boilerplate(docs, verdict).collect()}
    assert set(cleaned) == {i for i, k in kept.items() if k}
    assert cleaned[0]["text"] == own[0] and cleaned[0]["n_chars"] == len(own[0])
    assert cleaned[31]["text"] == f"{own[3]}\n{shared}" and cleaned[0]["key"] == "extra"


# ------------------------------------------------------------ 8

def test_mixing(docs, labels, frame):
    p = mixing.Mixing()
    got = mixing.mixing_rates(docs, labels, p).toPandas()
    assert len(got) == docs.count() and (got["rate"] >= 0).all()
    assert np.allclose(got[["p_good", "p_weak", "p_toxic"]].sum(axis=1), 1)
    out = mixing.mixed(docs, labels, p)
    assert out.columns == docs.columns
    none = mixing.mixing_rates(docs, labels.where("false"), p).toPandas()
    assert np.allclose(none["p_good"], 1 / 3)


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_default_rates_meet_the_targets(spark, size):
    read = lambda name: spark.read.parquet(f"/root/testdata/{size}/{name}.parquet")
    rows = mixing.reached(mixing.mixing_rates(read("documents"), read("labels"))).collect()
    assert [r["domain"] for r in rows] == list(mixing.DOMAINS)
    assert all(abs(r["expected"] / r["target"] - 1) < 0.1 for r in rows)


def test_targets_that_no_rates_meet_are_reported(spark, frame):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(50)], "doc_id bigint, quality int, toxic int")
    rates = mixing.mixing_rates(frame([(i, "plain prose " * 9, None) for i in range(60)]), labels)
    found = {r["domain"]: r for r in mixing.reached(rates).collect()}
    assert found["weak"]["expected"] < 0.5 * found["weak"]["target"] and found["good"]["expected"] > 0


def test_rates_meet_the_targets(spark, frame):
    good, bad = "fine clear prose about rivers and hills ", "zzz### qqq!!! zzz### "
    rows = [(i, (good if i % 3 else bad) * (5 + i % 7), None) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(400)], "doc_id bigint, quality int, toxic int")
    p = mixing.Mixing(weights=(0.8, 0.2, 0.0), epoch=1.0, steps=40, ridge=1e-3)
    r = mixing.mixing_rates(frame(rows), labels, p).toPandas()
    tokens = r["n_tokens"].sum()
    share = [(r["rate"] * r["n_tokens"] * r[c]).sum() / tokens for c in ("p_good", "p_weak")]
    assert share == pytest.approx([0.8, 0.2], abs=0.02)
    # the same problem solved densely: no feasible step lowers the objective
    a = r[["p_good", "p_weak", "p_toxic"]].to_numpy()
    n, x = r["n_tokens"].to_numpy(), r["rate"].to_numpy()
    spread = np.maximum((a**2 * n[:, None]).sum(0) / tokens, 1e-18)
    gap = (a * (n * x)[:, None]).sum(0) / tokens - np.array([0.8, 0.2, 0.0])
    gradient = a @ (gap / spread) + p.ridge * (x - 1)
    assert np.abs(np.where(x > 0, gradient, np.minimum(gradient, 0))).max() < 0.05


# ------------------------------------------------------------ 9

def luhn(s):
    return sum(v if not k % 2 else (v * 2 - 9 if v > 4 else v * 2) for k, v in enumerate(map(int, reversed(s)))) % 10 == 0


def base_spans(t):
    found = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    found += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        found += [("card", m)] if 16 <= len(d) <= 19 and luhn(d) else []
    found += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return [f"{k}:{m.start()}:{m.end()}" for k, m in found]


ODD = [
    "éé a@b.c_d@e.f x@y a.b@c.d.e.", "1.2.3.4.5 999.1.1.1 007.008.009.010 1.2.3 256.1.1.1", "4111 1111 1111 1111 x 4111-1111-1111-1112 4111111111111111",
    "+1 (555) 123-4567 +49 30 1234567 +1 +123 +123456789012345678", "a" * 6_000 + "@b.co " + "7" * 5_000 + ".1.1.1", "@@@..+++ 1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "", None,
]


def test_personal_data(docs, odd_rows, frame, clashing):
    for rows, df in ((odd_rows, docs), ([(i, t, None) for i, t in enumerate(ODD)], clashing(frame([(i, t, None) for i, t in enumerate(ODD)])))):
        got = pii.personal_data(df)
        want = Counter()
        for i, t, _ in rows:
            s = base_spans(t or "")
            want[(i, *[sum(x.startswith(k) for x in s) for k in pii.KINDS[:4]], sha(",".join(s)))] += 1
        assert table(got, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == want


def test_terms_that_give_entities_away(frame):
    rows = [(i, f"text{i} number one: Marguerite writes from m@site.org about thing{i} and common", None) for i in range(4)]
    rows += [(10 + i, f"filler number {i} with common words and writes about nothing", None) for i in range(30)]
    got = {r["doc_id"]: r["spans"] for r in pii.personal_data(frame(rows)).collect()}
    for i in range(4):
        spans = got[i].split(",")
        terms = {rows[i][1][int(a) : int(b)] for k, a, b in (s.split(":") for s in spans) if k == "term"}
        assert "Marguerite" in terms and "common" not in terms and "number" not in terms and f"thing{i}" not in terms
    clean = {r["doc_id"]: r["text"] for r in pii.sanitised(frame(rows), pii.Pii()).collect()}
    assert "m@site.org" not in clean[0] and "[email]" in clean[0] and "Marguerite" not in clean[0] and clean[12] == rows[6][1]


# ------------------------------------------------------------ 10

def near(rows, percent=85):
    sets = []
    for i, t, _ in rows:
        w = SPACE.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append(frozenset([tuple(w)] if 0 < len(w) < 5 else (tuple(w[j : j + 5]) for j in range(len(w) - 4))))
    ids = [i for i, _, _ in rows]
    comp = dict(zip(ids, ids))
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            for b in range(a):
                both = len(sets[a] & sets[b])
                if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    low = min(comp[ids[a]], comp[ids[b]])
                    changed |= comp[ids[a]] != low or comp[ids[b]] != low
                    comp[ids[a]] = comp[ids[b]] = low
    return Counter((i, len(s), comp[i], comp[i] == i) for i, s in zip(ids, sets))


def test_near_duplicates(docs, odd_rows):
    got = table(near_dup.near_duplicates(docs), "doc_id", "n_shingles", "component_id", "kept")
    known, unknown = ([r for r in odd_rows if (r[0] is None) == x] for x in (False, True))
    sizes = [(k, *r[1:]) for k, r in enumerate(unknown)]
    assert got == near(known) + Counter((None, n, None, True) for (_, n, _, _), c in near(sizes).items() for _ in range(c))


def test_first_pairs_grow_with_the_members_only(spark):
    """Every member of a group meets another centre in each bucket, and two of them in two buckets."""
    met = [(f"{b}-{a}", b, a, 40 - a) for b in range(40) for a in range(40)] + [(f"{b}+{a}", b, a, 40 - a) for b in range(40) for a in (30, 31)]
    found = near_dup.first_pairs(spark.createDataFrame(met, "key string, rep long, a long, weight long"), near_dup.NearDup())
    got = table(found, "b", "a")
    assert got == Counter((b, a) for b in range(40) for a in [x for x in (30, 31, 0, 1, 2) if x != b][:3])


def test_large_family_mostly_below_the_limit(frame):
    """Copies of one text with as many changes that most pairs are no link; a third of the rows has no id."""
    import random

    rnd = random.Random(8)
    base = [f"w{i}" for i in range(250)]
    rows = []
    for i in range(400):
        own = list(base)
        for _ in range(rnd.randint(2, 7)):
            own[rnd.randrange(250)] = f"x{rnd.random()}"
        rows.append((i, " ".join(own), None))
    nameless = [(None, t, s) for _, t, s in rows[:200]]
    p = near_dup.NearDup(tile=64, tile_shingles=20_000)
    got = table(near_dup.near_duplicates(frame(rows + nameless), p), "doc_id", "component_id", "kept")
    want = Counter((i, c, k) for i, _, c, k in near(rows).elements())
    assert got == want + Counter({(None, None, True): 200})
    assert 5 < sum(k for _, _, k in want) < 390


def test_bucket_keys_are_made_once_and_counted_in_their_bucket(spark):
    p = near_dup.NearDup()
    rnd = random.Random(11)
    one, two = (bytes(rnd.randrange(256) for _ in range(p.symbols)) for _ in range(2))
    near_one = bytes([one[0] ^ 1]) + one[1:]
    reps = spark.createDataFrame([(1, one), (2, near_one), (3, two), (4, one)], "rep long, signature binary")
    got = near_dup.shared_buckets(reps, p)
    plan = got._jdf.queryExecution().executedPlan().toString()
    # the keys go to their bucket without a table of them in every task
    assert plan.count("MapInArrow") == 1 and "Aggregate" not in plan
    keys = [tuple(r) for r in near_dup.bucket_keys(reps, p).collect()]
    size = Counter(k for k, _, _ in keys)
    want = Counter((k, r, at, size[k]) for k, r, at in keys if size[k] > 1)
    assert table(got, "key", "rep", "left_out", "size") == want
    assert {r for _, r, _, _ in want} == {1, 2, 4} and {n for _, _, _, n in want} == {2, 3}


def test_chain_and_tiles_of_near_copies(frame):
    import random

    rnd = random.Random(2)
    base = [f"w{rnd.randint(0, 10**6)}" for _ in range(300)]
    rows, now = [], list(base)
    for i in range(60):
        now = list(now)
        now[rnd.randrange(300)] = f"c{i}"
        rows.append((i, " ".join(now), None))
    for i in range(60, 120):
        own = list(base)
        for _ in range(rnd.randint(0, 12)):
            own[rnd.randrange(300)] = f"d{i}x{rnd.random()}"
        rows.append((i, " ".join(own), None))
    p = near_dup.NearDup(tile=16, centres=1)
    assert table(near_dup.near_duplicates(frame(rows), p), "doc_id", "n_shingles", "component_id", "kept") == near(rows)


# ------------------------------------------------------------ 1

def test_permutation_is_one():
    for n in (1, 2, 3, 17, 1000, 4097):
        slots = token_shards.permute(np.arange(n), n, 7, 6)
        assert sorted(slots) == list(range(n))
        assert (token_shards.permute(slots, n, 7, 6, back=True) == np.arange(n)).all()


def test_token_round_trip(docs, odd_rows):
    import tiktoken

    p = token_shards.TokenShards(length=64, slots=8)
    ranks = token_shards.read_ranks(p.vocabulary)
    enc = tiktoken.Encoding("t", pat_str=token_shards.PATTERN, mergeable_ranks=ranks, special_tokens={})
    shards = token_shards.token_shards(docs, p)
    rows = shards.collect()
    assert all(len(r["payload"]) == r["n_slots"] * r["stride"] == r["n_slots"] * 128 and sha(bytes(r["payload"])) == r["payload_sha256"] for r in rows)
    assert sorted(r["first_slot"] for r in rows) == [8 * k for k in range(len(rows))] and all(r["n_slots"] == 8 for r in rows if r["shard"] < len(rows) - 1)
    slots = token_shards.sequences(shards).collect()
    n = len(slots)
    assert sorted(s["slot"] for s in slots) == list(range(n))
    order = token_shards.permute(np.array([s["slot"] for s in slots]), n, p.key, p.rounds, back=True)
    ids = np.concatenate([np.frombuffer(bytes(slots[k]["tokens"]), np.uint16) for k in np.argsort(order)])
    got = Counter(enc.decode(list(t)) for t in np.split(ids, np.flatnonzero(ids == p.end) + 1) for t in [t[t != p.end]] if len(t))
    assert got == Counter(t for _, t, _ in odd_rows if t)
    later = token_shards.sequences(shards, n // 2).collect()
    assert sorted(s["slot"] for s in later) == list(range(n // 2, n))
    assert token_shards.missing(shards, shards.where("shard % 2 = 0")).count() == len(rows) // 2


@pytest.mark.parametrize("text", ["a b", "a  b", " a", "a ", "it's  we'll x", "\n\n a\n b", "tab\t x", "é ñ 12 3.5 !!   z", "a  b c", "x y z"])
def test_cached_words_are_encoded_alike(text):
    t = token_shards.Tokenizer(token_shards.read_ranks(token_shards.TokenShards().vocabulary))
    assert t(text) == t.direct(text) == t(text)


# ------------------------------------------------------------ 2, 6

def test_secret_scan(spark, frame, clashing):
    import random

    rnd = random.Random(1)
    code = lambda n: "".join(rnd.choice("0123456789abcdef") for _ in range(n))
    rows = [(i, f"some words here\nTOKEN = \"{code(40)}\" and more words", "src/app.py") for i in range(60)]
    rows += [(100 + i, f"contact someone{i}long.name@example.com for words " + "1234567890123456", "docs/a.md") for i in range(60)]
    rows += [(200, f"secret: '{code(32)}'", None), (201, None, None), (202, "", "x"), (203, "a" * 100_000 + "1", "x"), (None, f"token={code(40)}", "y")]
    docs = clashing(frame(rows))
    got = secrets.secret_scan(docs).toPandas()
    hit = got[got["is_secret"]]
    assert set(range(60)) <= set(hit["doc_id"].dropna().astype(int)) and not set(hit["doc_id"].dropna().astype(int)) & set(range(100, 160))
    assert ((got["end"] - got["first"]) == got["n_chars"]).all()
    found = got.dropna(subset=["doc_id"])
    given = spark.createDataFrame([(int(r.doc_id), int(r["first"]), int(r["end"]), bool(r.doc_id >= 100)) for _, r in found.iterrows()],
                                  "doc_id bigint, first bigint, end bigint, is_secret boolean")
    turned = secrets.secret_scan(docs, given.where("doc_id % 2 = 0")).toPandas().dropna(subset=["doc_id"])
    assert (turned[turned["doc_id"] % 2 == 1]["is_secret"] == (turned[turned["doc_id"] % 2 == 1]["doc_id"] >= 100)).mean() > 0.9
    one = secrets.secret_scan(docs, given.where("is_secret")).toPandas()
    assert len(one) == len(got)


def test_toxicity(spark, frame, clashing):
    import random
    import zlib

    rnd = random.Random(4)
    plain = [f"{a}{b}{c}" for a in "brst" for b in ("an", "ol", "ite") for c in ("da", "mer", "")]
    insults = ["idiot", "worthless", "moron", "scumbag"]
    rows, marks = [], []
    for i in range(500):
        w = [rnd.choice(plain) for _ in range(40)]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                w[rnd.randrange(40)] = rnd.choice(insults)
        rows.append((i, " ".join(w), None))
        marks.append((i, 1, int(toxic)))
    bad = [rnd.choice(plain) for _ in range(40)]
    bad[3], bad[5], bad[6] = "idi0t", "worthles", "mornon"
    swapped = list(bad)
    swapped[3], swapped[5], swapped[6] = "idoit", "wrothless", "mroon"
    quoted = [rnd.choice(plain) for _ in range(40)]
    quoted[7] = "\"idiot\""
    rows += [(1000, " ".join(bad), None), (1001, " ".join(quoted), None), (1002, None, None), (1003, "", None), (None, "idiot moron idiot", None), (1004, " ".join(swapped), None)]
    labels = spark.createDataFrame(marks + [(None, 1, 1), (7, 1, None)], "doc_id bigint, quality int, toxic int")
    docs = clashing(frame(rows))
    got = toxicity.toxicity(docs, labels).toPandas()
    assert len(got) == len(rows) and got["score"].between(0, 1).all()
    by = got.dropna(subset=["doc_id"]).set_index("doc_id")
    assert all(by.loc[i, "held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(500))
    held = [i for i in range(500) if by.loc[i, "held_out"]]
    assert np.mean([by.loc[i, "predicted"] == (i % 4 == 0) for i in held]) > 0.97
    assert by.loc[1000, "score"] > 10 * by.loc[1003, "score"] and by.loc[1004, "score"] > 10 * by.loc[1003, "score"]
    assert by.loc[1001, "score"] < by.loc[1000, "score"] and by.loc[1002, "score"] == by.loc[1003, "score"]
    assert (toxicity.toxicity(docs, labels.where("toxic = 0")).toPandas()["score"] == 0).all()


# ------------------------------------------------------------ all

def test_empty_tables(empty, labels, spark):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    for df in (near_dup.near_duplicates(empty), substrings.remove_repeats(empty), suffixes.remove_earlier(empty), quality.quality(empty),
               decontaminate.overlaps(empty, bench), pii.personal_data(empty), mixing.mixing_rates(empty, labels), toxicity.toxicity(empty, labels),
               secrets.secret_scan(empty), token_shards.token_shards(empty)):
        assert df.count() == 0
