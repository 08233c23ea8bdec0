import random
from collections import defaultdict

from goldleaf.llm import preference

TURNS = "pair_id long, side string, turn int, role string, text string, prompt string, n string"


def rendered(turns):
    return "".join(f"<|{r}|>\n{t}\n" for r, t in turns)


def spans(turns):
    at, out = 0, []
    for r, t in turns:
        start = at + len(r) + 5
        if r == "assistant":
            out.append((start, start + len(t)))
        at = start + len(t) + 1
    return out


def brute(rows):
    pairs = defaultdict(lambda: {"chosen": [], "rejected": []})
    for p, side, turn, role, text, *_ in rows:
        if side in ("chosen", "rejected"):
            safe = lambda x, d: (d if x is None else x).replace("<|", "<||")
            pairs[p][side].append(((turn is not None, turn or 0), safe(role, "unknown"), safe(text, "")))
    out = []
    for p, s in pairs.items():
        c, r = ([x[1:] for x in sorted(s[k])] for k in ("chosen", "rejected"))
        n = 0
        while n < min(len(c), len(r)) and c[n] == r[n]:
            n += 1
        out.append((p, n, rendered(c[:n]), rendered(c[n:]), rendered(r[n:]), spans(c[n:]), spans(r[n:])))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.pair_id, r.n_prompt_turns, r.prompt, r.chosen, r.rejected, [tuple(x) for x in r.chosen_mask],
                    [tuple(x) for x in r.rejected_mask]) for r in preference.format_pairs(df).collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], TURNS)


def test_pairs_against_brute_force(spark):
    rng = random.Random(6)
    rows = []
    for p in list(range(60)) + [None]:
        base = [(t, "user" if t % 2 == 0 else "assistant", rng.choice(["hi", "", "a<|b", "é\U0001F600 z", "line\nbreak"])) for t in range(rng.randrange(6))]
        for side in ("chosen", "rejected"):
            turns = list(base)
            for _ in range(rng.choice([0, 1, 2])):
                turns.append((len(turns), rng.choice(["assistant", "user", None, "sys<|tem"]), rng.choice(["x", "y", None])))
            if rng.random() < .2:
                turns = turns[:rng.randrange(len(turns) + 1)]
            if rng.random() < .3 and turns:
                turns.append(rng.choice(turns))                       # a repeated row
            if rng.random() < .3:
                turns += [(None, "assistant", "before"), (2, "assistant", "same number"), (2, "user", "same number")]
            rows += [(p, side, *t) for t in turns]
    rows += [(7, "other", 0, "user", "left out"), (900, "other", 0, "user", "no pair"), (901, None, 0, "user", "no pair")]
    rng.shuffle(rows)
    want = brute(rows)
    assert got(frame(spark, rows)) == want
    assert any(x[1] > 2 for x in want) and any(x[1] == 0 for x in want) and any(not x[3] for x in want)


def test_one_side_same_sides_and_empty_table(spark):
    same = [(1, s, t, r, "t") for s in ("chosen", "rejected") for t, r in enumerate(["user", "assistant"])]
    rows = same + [(2, "chosen", 0, "assistant", "only")]
    assert got(frame(spark, rows)) == [(1, 2, "<|user|>\nt\n<|assistant|>\nt\n", "", "", [], []),
                                       (2, 0, "", "<|assistant|>\nonly\n", "", [(14, 18)], [])]
    assert preference.format_pairs(frame(spark, rows).limit(0)).count() == 0


def test_masks_cut_out_the_assistant_texts(spark):
    rows = [(1, s, t, ("user", "assistant")[t % 2], f"\U0001F600{s}{t}") for s in ("chosen", "rejected") for t in range(6)]
    r = preference.format_pairs(frame(spark, rows)).first()
    for text, mask, s in ((r.chosen, r.chosen_mask, "chosen"), (r.rejected, r.rejected_mask, "rejected")):
        assert [text[x["start"]:x["end"]] for x in mask] == [f"\U0001F600{s}{t}" for t in (1, 3, 5)]


def test_long_conversation_and_a_hot_first_turn(spark):
    """4,000 turns in one conversation, and one first turn that all pairs share."""
    rows = [(0, s, t, ("user", "assistant")[t % 2], f"turn {t}" + ("" if t < 2000 else s)) for s in ("chosen", "rejected") for t in range(4000)]
    rows += [(p, s, t, "assistant" if t else "user", f"{s}{p}" if t else "the same start") for p in range(1, 200) for s in ("chosen", "rejected") for t in (0, 1)]
    have = got(frame(spark, rows))
    assert have == brute(rows) and {x[1] for x in have if x[0]} == {1} and [x[1] for x in have if x[0] == 0] == [2000]


def test_mismatched_pairs(spark):
    conv = "conv_id long, turn int, role string, text string, side string"
    rows = [(c, t, "user" if t == 0 else "assistant", f"c{c}t{t}", "clash") for c in (0, 1, 4) for t in range(3)] + [(None, 0, "user", "x", "clash")]
    rows += [(4, 2, "assistant", "c4t2", "clash")]                    # the last turn twice
    pairs = preference.mismatched_pairs(spark.createDataFrame(rows, conv))
    by = defaultdict(list)
    for r in pairs.collect():
        by[r.pair_id, r.side].append((r.turn, r.text))
    assert sorted(by) == [(c, s) for c in (0, 1, 4) for s in ("chosen", "rejected")]
    assert sorted(by[0, "rejected"]) == [(0, "c0t0"), (1, "c0t1"), (2, "c1t2")] and sorted(by[1, "rejected"])[-1] == (2, "c0t2")
    assert sorted(by[4, "chosen"])[-2:] == [(2, "c4t2")] * 2 and sorted(by[4, "rejected"]) == [(0, "c4t0"), (1, "c4t1")]
