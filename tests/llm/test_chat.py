"""Chat formatting: exact round trips, budgets and masks, on odd texts and long conversations."""

import collections
import hashlib
import random

from pyspark.sql import functions as F

from roadspark.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def truth(rows):
    groups = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((-(2**63) if turn is None else turn, role or "", text or ""))
    out = {}
    for conv, turns in groups.items():
        turns.sort()
        whole = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def read_back(spark, rows):
    found = chat.digests(chat.windows(spark.createDataFrame(rows, SCHEMA))).collect()
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found}


def test_odd_texts_read_back(spark):
    rnd = random.Random(1)
    bits = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "[SYS]", "[/SYS] ", "[TEXT]", " [/ROLE]", " ", "\n", "é", "x", " [OUT] "]
    rows = []
    for conv in (None, 1, 2):
        for k in range(30):
            text = rnd.choice([None, "", *["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 200)))] * 6])
            rows.append((conv, rnd.choice([None, k, k]), rnd.choice(["user", "assistant", "system", "tool", None, "we [TEXT] ird\\"]), text))
    rows += rows[:5]
    assert read_back(spark, rows) == truth(rows)


def test_budget_history_and_mask(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, k, "user" if k % 2 else "assistant", f"{k} " + "abc " * (k % 37)) for k in range(1, 2500)]
    df = chat.windows(spark.createDataFrame(rows, SCHEMA)).cache()
    assert df.agg(F.max("n_tokens")).first()[0] <= chat.BUDGET
    texts = {r.window: r.formatted for r in df.collect()}
    assert len(texts) > 50 and all(t.startswith("[SYS] be kind [/SYS]") for t in texts.values())
    assert df.where("window > 0 and own_from > 1").count() > 40  # history beyond the system turn
    assert read_back(spark, rows) == truth(rows)


def test_budget_with_turns_of_hundreds_of_tokens(spark):
    """Long turns and a long system turn keep the budget unless one turn and the system turn alone exceed it."""
    rnd = random.Random(3)
    for system, largest in ((0, 500), (200, 300), (450, 500)):
        rows = [(1, 0, "system", "s" * (4 * system - 12))] if system else []
        rows += [(1, k, "user" if k % 2 else "assistant", "t" * (4 * rnd.randint(300 if largest > 300 else 20, largest) - 16)) for k in range(1, 300)]
        for w in chat.windows(spark.createDataFrame(rows, SCHEMA)).collect():
            turns = w.formatted.split("\n")
            others = sum(not t.startswith("[SYS]") for t in turns)  # besides the system turn
            assert w.n_tokens == sum(-(-(len(t) + 1) // 4) for t in turns)
            assert w.n_tokens <= chat.BUDGET or others == 1, (w.n_tokens, others)
        assert read_back(spark, rows) == truth(rows)


def test_windows_are_well_filled(spark):
    rnd = random.Random(4)
    rows = [(1, k, "user" if k % 2 else "assistant", "word " * rnd.randint(4, 100)) for k in range(3000)]
    sizes = [r.n_tokens for r in chat.windows(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert max(sizes) <= chat.BUDGET and sum(sizes) / len(sizes) > 0.8 * chat.BUDGET


def test_many_turns_of_one_number(spark):
    """A block of more turns than fit one part, blocks apart from each other, and no turn numbers."""
    rows = [(1, 5, "user", f"q {k:05d}") for k in range(3000)] + [(1, 10**15, "assistant", "late"), (1, 10**15 + 1500, "user", "later")]
    rows += [(None, None, "assistant", f"a {k:05d}") for k in range(2500)] + [(2, -3000 + k, "user", str(k)) for k in range(5000)]
    assert read_back(spark, rows) == truth(rows)
    assert chat.windows(spark.createDataFrame(rows, SCHEMA)).agg(F.max("n_tokens")).first()[0] <= chat.BUDGET


def test_who_is_the_system_turn(spark):
    rows = [(1, 0, "system", "b"), (1, 0, "system", "a"), (1, 1, "user", "x"), (2, 0, "assistant", "first"), (2, 0, "system", "second"), (3, 1, "user", "x"), (3, 2, "system", "no"), (4, 0, "system", "alone"), (5, None, "system", "null"), (5, 0, "user", "x")]
    found = {r.conv_id: r.formatted for r in chat.windows(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found[1] == "[SYS] a [/SYS]\n[SYS] b [/SYS]\n[INST] x [/INST]" and found[4] == "[SYS] alone [/SYS]"
    assert found[2].startswith("[OUT] first") and found[3].startswith("[INST] x") and found[5].startswith("[SYS] null")
    assert read_back(spark, rows) == truth(rows)


def test_one_turn_larger_than_the_budget(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "long " * 5000), (1, 2, "user", "r"), (1, 3, "assistant", "s")]
    assert read_back(spark, rows) == truth(rows)


def test_empty_and_extra_columns(spark):
    assert chat.digests(chat.windows(spark.createDataFrame([], SCHEMA))).count() == 0
    rows = spark.createDataFrame([(1, 0, "user", "a", "z")], SCHEMA + ", window string")
    assert chat.digests(chat.windows(rows)).count() == 1


def test_turn_numbers_do_not_matter(spark):
    """Windows follow the order of turns, however sparse their numbers are."""
    rnd = random.Random(6)
    for n in (20, 2500):
        texts = ["short"] * 20 if n == 20 else ["word " * rnd.randint(1, 40) for _ in range(n)]
        found = []
        for number in (lambda k: k, lambda k: 2000 * k, lambda k: 500 * k - 10**6, lambda k: 1_700_000_000_000 + 60_000 * k, lambda k: k // 3 * 1024 if n > 20 else k * 1024):
            rows = [(1, number(k), "user" if k % 2 else "assistant", f"{k:05d} {t}") for k, t in enumerate(texts)]
            if number(1) == number(0):  # equal numbers go by role and text
                rows = [(c, t, "user", x) for c, t, _, x in rows]
                assert read_back(spark, rows) == truth(rows)
                continue
            windows = chat.windows(spark.createDataFrame(rows, SCHEMA).repartition(5)).orderBy("window").collect()
            found.append([(w.formatted, w.own_from, w.loss, w.n_tokens) for w in windows])
            assert read_back(spark, rows) == truth(rows)
        assert all(f == found[0] for f in found)
        assert len(found[0]) == 1 if n == 20 else sum(w[1] > 0 for w in found[0]) > len(found[0]) - 2


def test_history_crosses_parts(spark, monkeypatch):
    """Every window but the first repeats turns, also where a part begins."""
    rows = [(1, 7 * k, "user" if k % 2 else "assistant", f"turn {k} " + "x" * (k % 50)) for k in range(900)]
    whole = truth(rows)
    for part in (200, 300, 1024):
        monkeypatch.setattr(chat, "PART", part)
        found = chat.windows(spark.createDataFrame(rows, SCHEMA)).orderBy("window").collect()
        assert found[0].own_from == 0 and all(w.own_from > 0 for w in found[1:]) and max(w.n_tokens for w in found) <= chat.BUDGET
        assert read_back(spark, rows) == whole


def test_no_python_on_the_way(spark):
    plan = chat.digests(chat.windows(spark.createDataFrame([(1, 0, "user", "a")], SCHEMA)))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
