"""Cases that the operators once did by halves."""

import itertools
import random
from collections import Counter

import corpus_pipeline
from casemill.llm import decontaminate, near_dup, pii, quality, secrets, toxicity


# ------------------------------------------------------------ pipeline, near duplicates

def test_near_dedup_stage_links_from_four_fifths(spark, frame):
    rnd = random.Random(8)
    rows = []
    for k in range(20):
        base = [f"w{rnd.randint(0, 10**9)}" for _ in range(100)]
        copy = list(base)
        copy[30], copy[70] = "one", "two"  # 86 of 106 shingles: 0.811
        far = list(base)
        far[20], far[40], far[60] = "one", "two", "three"  # 81 of 111: 0.73
        rows += [(3 * k, " ".join(base), None), (3 * k + 1, " ".join(copy), None), (3 * k + 2, " ".join(far), None)]
    kept = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, frame(rows), "").collect()}
    assert kept == {i for i, _, _ in rows if i % 3 != 1}
    assert near_dup.near_duplicates(frame(rows)).where("kept").count() == len(rows)
    # chunks stay as selective as at 85 %
    assert min(b - a for a, b in corpus_pipeline.NEAR.chunks) >= 5 and 2 * len(corpus_pipeline.NEAR.chunks) > corpus_pipeline.NEAR.errors


# ------------------------------------------------------------ pipeline, quality rules

def test_rows_without_id_get_their_own_verdict(frame, clashing):
    own = [" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}x{j}" for j in range(30)) for i in range(40)]
    lines = ["Subscribe to our newsletter", "All rights reserved"]
    rows = [(None, f"{own[i]}\n{lines[i % 2]}", "h") for i in range(30)]
    rows += [(None, "too short", "h"), (None, own[30], "h"), (None, own[30], "h"), (None, None, "h"), (None, own[30], None)]
    rows += [(7, "short as well", "h"), (7, own[31], "h"), (7, f"{own[32]}\n{lines[0]}", "h"), (7, f"{own[32]}\n{lines[0]}", "h")]
    docs = clashing(frame(rows))
    got = Counter((r["doc_id"], r["text"], r["source"]) for r in quality.without_boilerplate(docs, quality.quality(docs)).collect())
    want = Counter((i, t if t in own else t.split("\n")[0], s) for i, t, s in rows if t and len(t) > 40)
    assert got == want


# ------------------------------------------------------------ 5

def test_masks_hit_every_pattern_of_replaced_words():
    p = decontaminate.Decontaminate()
    for n in range(1, p.window + 1):
        equal = next(k for k in range(n + 1) if k >= p.agree * n)
        for gone in itertools.combinations(range(n), n - equal):
            assert any(not {at + o for o in m} & set(gone) for m in decontaminate.masks_for(n, p) for at in range(n - m[-1])), (n, gone)
    wide = decontaminate.Decontaminate(window=12, agree=0.5)  # 6 of 12: no set does, so runs of one word
    assert decontaminate.masks_for(12, wide) == ((0,),)


def test_overlaps_at_any_pattern_and_length(spark, frame):
    items = {n: [f"i{n}w{k}" for k in range(n)] for n in (*range(1, 16), 20)}
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id bigint, text string")
    rows, want = [], set()
    for n, w in items.items():
        width = min(n, 15)
        spare = width - next(k for k in range(width + 1) if k >= 0.8 * width)
        for gone in itertools.combinations(range(width), spare):
            at = len(rows)
            changed = ["other" if k in gone or k >= width else x for k, x in enumerate(w)]
            rows.append((at, " ".join(["before", *changed, "after"]), None))
            want.add((at, n, width - spare))
        more = tuple(range(0, spare + 1))  # one replaced word too many
        rows.append((len(rows), " ".join("other" if k in more or k >= width else x for k, x in enumerate(w)), None))
    got = {(r["doc_id"], r["item_id"], r["n_equal"]) for r in decontaminate.overlaps(frame(rows), bench).collect()}
    assert got == want


# ------------------------------------------------------------ 9

def test_terms_far_from_the_entity(frame):
    gap = "and then the usual filler words of every letter come here again and again " * 3
    rows = [(i, f"Marguerite wrote {gap} to m@marguerite.org {gap} signed MARGUERITE {i}", None) for i in range(4)]
    rows += [(10 + i, f"filler {gap} wrote signed number {i}", None) for i in range(30)]
    rows += [(50 + i, f"Marguerittes other@site{i}.org {gap}", None) for i in range(3)]
    got = {r["doc_id"]: r["spans"].split(",") for r in pii.personal_data(frame(rows)).collect()}
    for i, text, _ in rows[:4]:
        spans = [(int(a), int(b)) for k, a, b in (s.split(":") for s in got[i]) if k == "term"]
        assert [text[a:b] for a, b in spans] == ["Marguerite", "MARGUERITE"]
    assert all("term" not in s for i in got if i >= 4 for s in got[i])
    clean = {r["doc_id"]: r["text"] for r in pii.sanitised(frame(rows)).collect()}
    assert "arguerite" not in clean[0] and "MARGUERITE" not in clean[0]


def test_disclosure_equals_brute_force(frame):
    import math
    import re

    rnd = random.Random(3)
    people = [(f"p{k}@x{k}.org", f"name{chr(97 + k) * 2}") for k in range(8)]
    rows = []
    for i in range(200):
        w = [f"word{chr(97 + rnd.randrange(26))}" for _ in range(30)]
        for mail, name in rnd.sample(people, rnd.randrange(3)):
            w[rnd.randrange(30)] = mail
            w[rnd.randrange(30)] = name if rnd.random() < 0.9 else "nobody"
        rows.append((i, " ".join(w), None))
    rows += [(1000 + k, rows[3][1], None) for k in range(5)]
    mails = [set(re.findall(r"p\d@x\d\.org", t)) for _, t, _ in rows]
    terms = [set(re.findall(r"[a-z]{4,}", t)) for _, t, _ in rows]
    n, want = len(rows), set()
    for e in set().union(*mails):
        for t in set().union(*terms):
            both = [i for i in range(n) if e in mails[i] and t in terms[i]]
            n_e, n_t = sum(e in m for m in mails), sum(t in m for m in terms)
            if len({rows[i][1] for i in both}) >= 2 and math.log(len(both) * n / (n_t * n_e)) / math.log(n / n_e) >= 0.8:
                want |= {(rows[i][0], m.start(), m.end()) for i in both for m in re.finditer(r"[a-z]{4,}", rows[i][1]) if m[0] == t}
    spans = {(r["doc_id"], *map(int, s.split(":")[1:])) for r in pii.personal_data(frame(rows)).collect()
             for s in r["spans"].split(",") if s.startswith("term")}
    assert spans == want and len(want) > 50


# ------------------------------------------------------------ 6

def test_near_matches_of_beginnings_dropped_words_and_short_words():
    p = toxicity.Toxicity()
    found = {"idio": (100, 4.0), "idiot$": (60, 4.2), "moron": (90, 4.0), "moron$": (60, 4.1), "scum$": (50, 3.0)}
    entries = toxicity._distinct(found)
    entries += toxicity._near_only(found, entries, p)
    names = [t for t, _ in entries]
    assert {"idio", "moron", "scum$", "idiot~", "moron~"} == set(names)
    hit = lambda w: (h := toxicity.Lexicon(entries, p).hit(w)) and (names[h[0]], h[1])
    assert hit("moron") == hit("morons") == ("moron", True) and hit("idiot") == ("idio", True)
    assert hit("mornon")[1] is hit("mroons")[1] is hit("m0rons")[1] is False
    assert hit("idoit") == ("idiot~", False)
    assert hit("scvm") == hit("scmu") == hit("scuum") == ("scum$", False)
    assert hit("scm") is hit("scums") is hit("plain") is None


def test_no_near_word_is_passed_over():
    def edits(a, b):
        d = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if not i * j}
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a), len(b)]

    rnd = random.Random(6)
    lexicon = toxicity.Lexicon([("abcab$", 3.0), ("bbacab$", 2.0), ("cabba", 2.5)], toxicity.Toxicity())
    for _ in range(3000):
        w = "".join(rnd.choice("abc") for _ in range(rnd.randint(4, 9)))
        near = any(edits(w, e) <= 1 for e in ("abcab", "bbacab")) or any(edits(w[:n], "cabba") <= 1 for n in range(len(w) + 1))
        assert (lexicon.hit(w) is not None) == near, w


# ------------------------------------------------------------ 2

def test_short_and_split_secrets_are_candidates(spark, frame):
    values = {'password = "Tr0ub4dor&3" here': "Tr0ub4dor&3", "pwd: hunter22, next": "hunter22", "{'api_key': 'a!b@c#d$e%1'}": "a!b@c#d$e%1",
              "Authorization: Bearer ab12cd34": "ab12cd34", 'secret="two words 1"': "two words 1", "token=x9!": None, "no name abc123def": None}
    rows = [(i, t, "a.py") for i, t in enumerate(values)] + [(100, "plain text with Zx81 in it", "a.py")]
    got = {(r["doc_id"], r["first"], r["end"]) for r in secrets.secret_scan(frame(rows)).collect()}
    assert got == {(i, t.index(v), t.index(v) + len(v)) for i, (t, v) in enumerate(values.items()) if v}
    given = spark.createDataFrame([(100, 16, 20, True), (0, 12, 23, True), (100, 20, 900, True)], "doc_id bigint, first bigint, end bigint, is_secret boolean")
    found = {(r["doc_id"], r["first"], r["end"]): r for r in secrets.secret_scan(frame(rows), given).collect()}
    assert set(found) == got | {(100, 16, 20)} and found[(100, 16, 20)]["is_secret"]
    # many names in one run stay linear
    assert len(secrets.assigned_values("token=" * 50_000 + "abc12345", secrets.Secrets())) == 2
