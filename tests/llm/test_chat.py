import collections
import hashlib
import random

from pyspark.sql import functions as F

from wardloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, block string, system string"
PIECES = ["</s>", "<s>", "[INST]", "[/INST]", "<\\/s>", "[\\\\INST]", "\\", "<", "[", " ", "word ", "é", "\n", "s>", "/", "INST]", " [/INST] "]


def made():
    rng = random.Random(7)
    rows = []
    for conv in range(40):
        for turn in range(rng.randrange(1, 14)):
            role = "system" if turn == 0 and conv % 3 == 0 or turn == 4 and conv % 5 == 0 else rng.choice(["user", "assistant", "assistant", "tool</s>", " [/INST]x "])
            rows.append((conv, turn, role, "".join(rng.choice(PIECES) for _ in range(rng.randrange(0, 30))), "x", "y"))
    rows += [(None, 0, "user", "a", "x", "y"), (None, None, None, None, "x", "y"), (50, 1, "assistant", "twice", "x", "y"), (50, 1, "assistant", "twice", "x", "y")]
    rows += [(51, 0, "user", "long " * 20_000, "x", "y"), (51, 1, "assistant", "long " * 20_000, "x", "y"), (52, -3, "user", "before", "x", "y"), (52, 2, "assistant", "", "x", "y")]
    return rows


def expected(rows):
    by = collections.defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    found = {}
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        found[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return found


def test_windows_read_back_exactly(spark):
    turns = spark.createDataFrame(made(), SCHEMA)
    for budget in (chat.Budget(), chat.Budget(tokens=30, history_turns=3, history_tokens=12, block=4)):
        windows = chat.format_windows(turns, budget=budget)
        found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(windows).collect()}
        assert found == expected(made())


def test_windows_keep_to_the_budget(spark):
    rows = [(1, i, "system" if i == 2 else "assistant" if i % 2 else "user", "w " * 5, "x", "y") for i in range(20)]
    budget = chat.Budget(tokens=60, history_turns=2, history_tokens=20, block=8)
    windows = sorted(chat.format_windows(spark.createDataFrame(rows, SCHEMA), budget=budget).collect(), key=lambda r: (r.block, r.window))
    assert len(windows) > 4
    for w in windows:
        pieces = w.formatted.split("</s>")[:-1]
        assert 9 * len(pieces) <= 60  # five words and four marks each
        assert len(pieces) - w.repeated >= 1
        for span in w.loss:
            assert w.formatted[span.start : span.start + span.length] == "w " * 5
    # the system turn is shown in every window that begins after it, history in all but the first
    assert all("[INST] system" in w.formatted for w in windows) and all(w.repeated >= 2 for w in windows[2:])


def test_history_shrinks_beside_long_system_turns(spark):
    rng = random.Random(9)
    rows = [(-1, 0, "system", "w " * 900, "x", "y"), (-1, 1, "user", "w " * 100, "x", "y"), (-1, 2, "assistant", "w " * 100, "x", "y")]
    for conv in range(60):
        rows.append((conv, 0, "system", "w " * rng.choice([5, 300, 600, 900, 1_015, 1_500]), "x", "y"))
        rows += [(conv, i, "assistant" if i % 2 == 0 else "user", "w " * rng.choice([3, 60, 120, 240, 700, 1_100]), "x", "y") for i in range(1, 9)]
    windows = chat.format_windows(spark.createDataFrame(rows, SCHEMA))
    over = 0
    for w in windows.collect():
        sizes = [len(piece.split("[/INST]")[1].split()) + 4 for piece in w.formatted.split("</s>")[:-1]]
        if sum(sizes) > 1024:
            over += 1
            # the system turn and one other, or one turn alone
            assert len(sizes) == 1 or len(sizes) == 2 and w.repeated == 1 and "[INST] system" in w.formatted
    assert over > 0
    first = sorted(windows.where("conv_id = -1").select("window", "repeated").collect())
    assert [(r.window, r.repeated) for r in first] == [(0, 0), (1, 1), (2, 1)]
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(windows).collect()} == expected(rows)


def test_escapes_hide_control_strings_and_are_undone(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice(PIECES) for _ in range(12)) for _ in range(300)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e")).select("*", chat.unescape(F.col("e")).alias("u"))
    for r in rows.collect():
        assert r.u == r.t and not any(c in r.e for c in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_empty_table(spark):
    assert chat.digests(chat.format_windows(spark.createDataFrame([], SCHEMA))).collect() == []
