"""Texts that once went wrong: long runs of letters, apostrophes, blanks of other scripts, tiny items, rows without id."""

import re
import time

from pyspark.sql import functions as F

from casemill.llm import blocks, decontaminate, pii, quality, secrets, token_shards, toxicity

# the plain statement of what an assigned value stands behind, quadratic on long runs
NAMED = re.compile(secrets._NAMES + r"[A-Za-z_]*[\"'`]?\s*(?:=>|:=|[=:])\s*(?:(?:bearer|basic)\s+)?", re.IGNORECASE)


def test_assignments_are_found_as_stated():
    import random
    rnd = random.Random(3)
    parts = ["token", "Secret", "api-key", "api_key", "access", "-", "_", "id", "=", ":", "=>", ":=", " ", "\n", '"', "'", "bearer ", "auth", "x9", "private-key"]
    for _ in range(20_000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 14)))
        assert list(secrets.assignments(text)) == [m.end() for m in NAMED.finditer(text)], text


def test_long_runs_take_linear_time():
    begin = time.monotonic()
    for text in ("token" * 200_000, "token" * 200_000 + "-x=", "api-" * 200_000 + "=", "token" + " " * 1_000_000, 'token="' * 100_000):
        secrets.assigned_values(text, secrets.Secrets())
    assert time.monotonic() - begin < 20


def test_apostrophes_quote_nothing():
    words = lambda t: {t.split()[i] for i in toxicity.quoted_words(t)}
    assert words("you’re an idiot") == words("I don’t know, idiot") == words("the boys’ idiot") == set()
    assert words("they said “you idiot” again") == {"“you", "idiot”"}
    assert words("«a» b „c d“ e ‘f g’ h \"i\" j") == {"«a»", "„c", "d“", "‘f", "g’", "\"i\""}
    assert words("‘tis said \"idiot\" here") == {"\"idiot\""}
    assert words("an \"open mark\nand another\" line") == set()
    lexicon = toxicity.Lexicon([("idiot", 4.0)], toxicity.Toxicity())
    plain = toxicity.features("you're an idiot", lexicon)
    assert toxicity.features("you’re an idiot", lexicon) == plain
    assert toxicity.features("you called me “an idiot”", lexicon) != toxicity.features("you called me an idiot", lexicon)


def test_a_line_of_wide_blanks_is_cut_like_any_other(frame):
    own = lambda k: " ".join(f"w{k}x{j}" for j in range(30))
    docs = frame([(k, own(k).translate(str.maketrans("0123456789", "abcdefghij")) + "\n　\n" + "menu", "s") for k in range(30)])
    verdict = quality.quality(docs)
    assert {r["boilerplate_words"] for r in verdict.collect()} == {2}
    assert all("　" not in r["text"] and "menu" not in r["text"] for r in quality.without_boilerplate(docs, verdict).collect())


def test_tiny_items_drop_no_document(spark, frame):
    bench = spark.createDataFrame([(1, "the"), (2, "one two three four five")], "item_id bigint, text string")
    docs = frame([(1, "the cat", "s"), (2, "a one two three four five b", "s"), (3, "other", "s")])
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(docs, bench).collect()} == {(1, 1), (2, 2)}
    assert {r["doc_id"] for r in decontaminate.decontaminated(docs, bench).collect()} == {1, 3}


def test_columns_of_personal_data(frame):
    assert pii.personal_data(frame([])).columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_term"]


def test_rows_without_id_are_spread(frame):
    docs = frame([(k if k % 3 else None, f"text {k}", "s") for k in range(3000)])
    sizes = sorted(r["count"] for r in blocks.by_block(docs).groupBy("block").count().collect())
    assert sizes[-1] < 2 * sizes[len(sizes) // 2]


def test_shard_files_are_read_by_offset_and_resumed(spark, frame, tmp_path):
    docs = frame([(k, f"text number {k} " * (k % 40 + 1), "s") for k in range(300)])
    p = token_shards.TokenShards(length=32, slots=8)
    shards = token_shards.token_shards(docs, p).cache()
    folder = str(tmp_path / "shards")
    first = token_shards.write_files(shards.where("shard % 3 > 0"), folder)
    manifest = token_shards.write_files(token_shards.missing(shards, first), folder)
    rows = manifest.collect()
    assert len(rows) == shards.count() == len({r["shard"] for r in rows}) > 20
    stored = {r["slot"]: bytes(r["tokens"]) for r in token_shards.sequences(shards).collect()}
    for r in rows:
        with open(f"{folder}/{r['file']}", "rb") as f:
            for s in range(r["first_slot"], r["first_slot"] + r["n_slots"]):
                f.seek((s - r["first_slot"]) * r["stride"])
                assert f.read(r["stride"]) == stored[s]
    assert not [x for x in (tmp_path / "shards").iterdir() if x.name.startswith(".shard")]


def test_large_ids_take_four_bytes(frame, tmp_path):
    import base64

    import numpy as np
    path = tmp_path / "ranks"
    path.write_text("".join(f"{base64.b64encode(bytes([b])).decode()} {b + 70_000}\n" for b in range(256)))
    p = token_shards.TokenShards(str(path), end=100_000, length=16, slots=4)
    rows = token_shards.token_shards(frame([(1, "abc é", "s")]), p).collect()
    ids = np.frombuffer(bytes(rows[0]["payload"]), "<u4")
    assert rows[0]["stride"] == 64
    assert ids.tolist() == [70_000 + b for b in "abc é".encode()] + [100_000] * 10
