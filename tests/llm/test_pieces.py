import math
import random
from collections import Counter

import numpy as np
import sentencepiece

from goldleaf.llm import pieces
from goldleaf.llm.queries import op8_piece_sampling


def paths(word, v, m):
    """Every segmentation of a part with its weight, by plain recursion over the vocabulary."""
    pieces_of = {m.id_to_piece(i): i for i in range(m.get_piece_size()) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i))}

    def rec(rest):
        if not rest:
            yield (), 0.0
        for n in range(1, len(rest) + 1):
            if rest[:n] in pieces_of:
                i = pieces_of[rest[:n]]
                for tail, w in rec(rest[n:]):
                    yield (i, *tail), w - math.log(2.0 - m.get_score(i))

    return dict(rec(pieces.SPACE + word.replace(" ", pieces.SPACE)))


def test_sampled_segmentations_have_the_lattice_probabilities():
    v, m = pieces.Vocabulary(pieces.MODEL), sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    for word in ("then", "ation", "  a", "at   "):
        want = paths(word, v, m)
        z = sum(math.exp(w) for w in want.values())
        n = 40_000
        ids, ends = pieces.encode_texts(list(range(n)), [word] * n, v)
        got = Counter(tuple(x) for x in np.split(ids, ends[:-1]))
        assert set(got) <= set(want)
        for p, w in want.items():
            share = math.exp(w) / z
            assert abs(got[p] / n - share) < 5 * math.sqrt(share / n) + 1e-4


def test_round_trip_seeds_and_edge_cases(spark):
    texts = ["", " ", "  two  spaces ", "tab\tline\n\r\n", "▁ real mark ▁▁", "ß 融 🙂 \u0000 ​", "a" * 5000, "é" * 3000 + " end", None, "same text here", "same text here"]
    rows = [(i, t, "old") for i, t in enumerate(texts)] + [(None, "no key", "old"), (10, "same text here", "old")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    def run(d, **kw):
        return sorted(((r.doc_id, r.text, r.ids, r.decoded) for r in pieces.decode(pieces.encode(d, **kw)).collect()), key=str)
    got = run(df)
    assert len(got) == len(rows) and all(r[1] == r[3] for r in got)
    assert [r[2] for r in got if r[1] is None] == [None]
    assert run(df.repartition(7)) == got
    assert run(df, seed=1) != got
    assert len({tuple(r[2]) for r in got if r[0] == 10}) == 1
    assert run(df.limit(0)) == []
    both = pieces.encode(df, decoded="back")
    assert sorted(((r.doc_id, r.text, r.ids, r.back) for r in both.collect()), key=str) == got


def test_parts_join_to_the_text():
    assert pieces._parts("") == [" "] and pieces._parts(" ") == ["  "] and pieces._parts("a  b ") == [" a", "  b", " "]
    rng = random.Random(4)
    for _ in range(500):
        text = "".join(rng.choice("a  b") for _ in range(rng.randrange(12)))
        assert "".join(pieces._parts(text)) == " " + text and all(p.lstrip(" ") == "" or " " not in p.lstrip(" ") for p in pieces._parts(text))


def test_runs_of_spaces_draw_pieces_of_several_marks():
    v = pieces.Vocabulary(pieces.MODEL)
    ids, _ = pieces.encode_texts([0], ["x" + " " * 4000 + "y"], v)
    sizes = {len(v.decoded[i]) for i in ids if not v.decoded[i].strip(b" ")}
    assert len(sizes) > 1 and len(ids) < 4000


def test_one_long_text():
    v = pieces.Vocabulary(pieces.MODEL)
    for text in ("q" * 100_000, " " * 100_000, "ab c" * 50_000):
        ids, ends = pieces.encode_texts([1], [text], v)
        assert pieces.decode_ids(ids[:ends[0]], v) == text


def test_query_is_lossless(spark):
    got = op8_piece_sampling(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == 1000 and all(r.lossless and r.n_pieces >= 1 for r in got)
