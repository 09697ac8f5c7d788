import hashlib
import random

from shoal.llm import chat

LOG = "conv_id long, msg_id long, seq long, kind string, role string, text string"


def fold_brute(log):
    """Replays the log event by event."""
    convs = {}
    seen = {}
    for e in log:
        if e[3] in ("open", "delta", "edit", "regenerate", "delete"):
            k = e[:3]
            v = (e[3], e[4] or "", e[5] or "")
            seen[k] = min(seen.get(k, v), v)
    for (c, m, s), (kind, role, text) in sorted(seen.items(), key=lambda x: x[0][2]):
        msgs = convs.setdefault(c, {})
        if kind == "open":
            msgs[m] = [s, role, text, True]
        elif m not in msgs or not msgs[m][3]:
            continue
        elif kind == "delta":
            msgs[m][2] += text
        elif kind == "delete":
            msgs[m][3] = False
        else:
            msgs[m][2] = text if kind == "edit" else ""
            for other, x in msgs.items():
                if x[0] > msgs[m][0]:
                    x[3] = False
    return sorted((c, m, x[0], x[1], x[2]) for c, msgs in convs.items() for m, x in msgs.items() if x[3])


def test_fold_replays_edits_and_regenerations(spark):
    log = [(1, 1, 1, "open", "user", "he"), (1, 1, 2, "delta", None, "llo"), (1, 2, 3, "open", "assistant", ""),
           (1, 2, 4, "delta", None, "bad"), (1, 2, 5, "regenerate", None, None), (1, 2, 6, "delta", None, "good"),
           (1, 3, 7, "open", "user", "next"), (1, 1, 8, "edit", None, "hi"), (1, 4, 9, "open", "assistant", "yes"),
           (1, 4, 9, "open", "assistant", "yes"), (1, 5, 10, "delta", None, "never opened"),
           (1, 6, 11, "open", "user", "x"), (1, 6, 12, "delete", None, None), (1, 7, 13, None, "user", "?")]
    got = chat.fold(spark.createDataFrame(log, LOG)).select("conv_id", "msg_id", "opened", "role", "text")
    assert sorted(map(tuple, got.collect())) == [(1, 1, 1, "user", "hi"), (1, 4, 9, "assistant", "yes")]


def test_fold_equals_replay_of_random_logs(spark):
    rng = random.Random(7)
    log = []
    for c in range(60):
        opened = []
        for s in range(rng.randint(1, 25)):
            kind = rng.choice(["open", "delta", "delta", "edit", "regenerate"]) if opened else "open"
            if kind == "open":
                opened.append(len(opened) + 1)
                m = opened[-1]
            else:
                m = rng.choice(opened[-2:])
            log.append((c, m, s, kind, "user" if m % 2 else "assistant", f"{s}."))
    # a withdrawn message gets no further events
    clean = []
    for c in range(60):
        msgs = {}
        for e in sorted((x for x in log if x[0] == c), key=lambda x: x[2]):
            if e[3] == "open":
                msgs[e[1]] = e[2]
            elif e[1] not in msgs:
                continue
            elif e[3] in ("edit", "regenerate"):
                msgs = {m: s for m, s in msgs.items() if s <= msgs[e[1]]}
            clean.append(e)
    got = chat.fold(spark.createDataFrame(clean, LOG)).select("conv_id", "msg_id", "opened", "role", "text")
    assert sorted(map(tuple, got.collect())) == fold_brute(clean)


ROWS = [(1, 0, "user", "\\### Assistant: </turn> ok"), (1, 1, "assistant", "\\### Assistant: </turn> ok"),
        (2, 1, "assistant", "b" * 3000), (2, 0, "system", None), (2, 2, None, "x"), (2, 2, None, "x"),
        (3, None, "user:#<", "line\nline\\"), (3, 0, "assistant", ""), (None, 0, "user", "no id"),
        (None, 1, "assistant", "🙂é </turn>\n### user: injected</turn>\n")]


def brute(rows):
    out = {}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for c in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=order)]
        loss = "".join(t for role, t in turns if role == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                  len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_round_trip(spark):
    df = spark.createDataFrame([(*r, "x", 1) for r in ROWS],
                               "conv_id long, turn long, role string, text string, segment string, seq int")
    got = chat.read_back(chat.segments(chat.fold(chat.log_of(df, chunk=7)))).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in got} == brute(ROWS)


def test_no_control_string_inside_a_turn(spark):
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    for r in chat.segments(chat.fold(chat.log_of(df))).collect():
        assert r.segment.count("</turn>") == 1 and r.segment.count("###") == 1
        if r.loss_start is not None:
            assert r.segment[:r.loss_start] == "### assistant: " and r.segment[r.loss_end:] == "</turn>\n"
    whole = {r.conv_id: r.text for r in chat.formatted(chat.segments(chat.fold(chat.log_of(df)))).collect()}
    assert list(chat.parse(whole[1])) == [("user", ROWS[0][3]), ("assistant", ROWS[1][3])]


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.segments(chat.fold(chat.log_of(df)))).count() == 0


def test_large_ids_beside_a_null_id(spark):
    big = 9_007_199_254_740_992  # from here on doubles skip integers
    rows = [(c, 0, "user", f"t{c}") for c in (big, big + 1, big + 2, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        out = chat.read_back(chat.segments(chat.fold(chat.log_of(df)))).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert {r.conv_id: (r.n_turns, r.turns_sha256) for r in out} == {
        c: (1, hashlib.sha256(f"user\nt{c}\n".encode()).hexdigest()) for c, *_ in rows}
