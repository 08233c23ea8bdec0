"""SentencePiece encoding by forward-filtering backward-sampling over the piece lattice, and lossless decoding.

A text, with a space mark before it, is cut where a run of spaces begins, as no piece of the model has a space after another
character; each part is a lattice whose edges are the vocabulary's pieces (and the byte pieces of a character that has none). Forward filtering sums the weights of all paths to each node
once per distinct part; backward sampling then draws, per occurrence, one path with its exact probability.
All steps run on arrays over millions of parts. The random numbers are a hash of the row's key, the place of
the part in the row and the step, so a row's pieces do not depend on its neighbours, partitions or retries.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from goldleaf.llm.chunks import mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Characters of text that are encoded at a time, some 200 MB of working memory.
SLICE_CHARS = 2_000_000
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)


class Vocabulary:
    """Pieces of a model with log weights, as hash tables. Scores of a BPE model are merge ranks, not log
    probabilities; a piece of rank r then weighs 1 / (r + 2), after Zipf's law."""

    def __init__(self, model_file: str, alpha: float = 1.0):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = m.get_piece_size()
        plain = [i for i in range(n) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
        score = {i: m.get_score(i) for i in plain}
        ranked = all(s == int(s) for s in score.values())
        weight = {i: alpha * (-np.log(2.0 - s) if ranked else s) for i, s in score.items()}
        floor = min(weight.values(), default=0.0)
        self.decoded = [b""] * n  # bytes of each id; the space mark is a space
        self.byte_ids = np.zeros(256, np.int32)
        for i in range(n):
            if m.is_byte(i):
                b = int(m.id_to_piece(i)[3:5], 16)
                self.decoded[i], self.byte_ids[b] = bytes([b]), i
        self.byte_weight = floor
        pieces = {}
        for i in plain:
            p = m.id_to_piece(i).replace(SPACE, " ")
            self.decoded[i] = p.encode()
            if " " in p.lstrip(" "):
                raise ValueError(f"piece {i} has a space after another character")
            pieces[p] = (i, weight[i])
        if " " not in pieces:
            raise ValueError("the model has no piece for a space alone")
        self.longest = max(map(len, pieces))
        self.pieces = _Table(pieces)


def _extend(h: np.ndarray, codes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return h * _BASE + codes.astype(np.uint64) + _U(1)


class _Table:
    """Piece text -> (id, weight) for arrays of text hashes."""

    def __init__(self, pieces: dict[str, tuple[int, float]]):
        keys = np.zeros(len(pieces), np.uint64)
        self.begins = np.zeros(1 << 22, bool)  # texts that a piece begins with, and a few others
        by_size = defaultdict(list)
        for i, p in enumerate(pieces):
            by_size[len(p)].append((i, p))
        for size, same in by_size.items():
            codes = np.frombuffer("".join(p for _, p in same).encode("utf-32-le"), np.uint32).reshape(-1, size)
            h = np.zeros(len(same), np.uint64)
            for c in codes.T:
                h = _extend(h, c)
                self.begins[(mix(h) >> _U(42)).astype(np.int64)] = True
            keys[[i for i, _ in same]] = mix(h)
        self.maybe = np.zeros(1 << 22, bool)  # pieces, and a few others
        self.maybe[(keys >> _U(42)).astype(np.int64)] = True
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ids = np.array([x[0] for x in pieces.values()], np.int32)[order]
        self.weights = np.array([x[1] for x in pieces.values()])[order]

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in h that some piece may begin with, those that are pieces, and the rows of the latter in the table."""
        h = mix(h)
        slot = (h >> _U(42)).astype(np.int64)
        at = np.flatnonzero(self.maybe[slot])
        row = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        good = self.keys[row] == h[at]
        return np.flatnonzero(self.begins[slot]), at[good], row[good]


def _n_bytes(code: np.ndarray) -> np.ndarray:
    return 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)


class Lattices:
    """The filtered lattices of distinct parts.

    A part of n characters has nodes at depth 0 to n. Nodes are numbered by depth and, within one, from the
    longest part on, so edges sorted by target are also in filtering order.
    """

    def __init__(self, parts: list[str], v: Vocabulary):
        lens = np.fromiter(map(len, parts), np.int64, len(parts))
        longest_first = np.argsort(-lens, kind="stable")
        codes = np.frombuffer("".join([parts[i] for i in longest_first]).encode("utf-32-le"), np.uint32)
        lens = lens[longest_first]
        depths = np.arange(int(lens.max(initial=0)) + 1)
        holders = len(lens) - np.searchsorted(lens[::-1], depths)  # parts that reach a depth
        offset = np.concatenate([[0], np.cumsum(holders)])
        rank = np.empty(len(parts), np.int64)
        rank[longest_first] = np.arange(len(parts))
        self.start = rank
        self.final = (offset[lens] + np.arange(len(lens)))[rank]
        part = np.repeat(np.arange(len(parts), dtype=np.int32), lens)
        begin = np.concatenate([[0], np.cumsum(lens)])[:-1]
        place = (np.arange(len(codes)) - begin[part]).astype(np.int32)
        left = (lens[part] - place).astype(np.int32)
        node_at = lambda at, more: (offset[place[at] + more] + part[at]).astype(np.int32)
        frm, to, row_of = [], [], []  # edges: a row of the table, or -1 - the character that is spelled in bytes
        h, at = np.zeros(len(codes), np.uint64), np.arange(len(codes), dtype=np.int32)
        for size in range(1, v.longest + 1):
            stays = left[at] >= size
            at, h = at[stays], h[stays]
            if size > 1 and not len(at):
                break
            h = _extend(h, codes[at + (size - 1)])
            going, where, row = v.pieces.find(h)
            frm.append(node_at(at[where], 0))
            to.append(node_at(at[where], size))
            row_of.append(row.astype(np.int32))
            if size == 1:
                bare = np.ones(len(codes), bool)
                bare[at[where]] = False
                bare = np.flatnonzero(bare)
                frm.append(node_at(bare, 0))
                to.append(node_at(bare, 1))
                row_of.append(-1 - codes[bare].astype(np.int32))
            at, h = at[going], h[going]
        frm, to, row_of = map(np.concatenate, (frm, to, row_of))
        order = np.argsort(to, kind="stable")
        frm, to, row_of = frm[order], to[order], row_of[order]
        spelled = np.minimum(row_of, -1)
        self.frm, self.piece = frm, np.where(row_of < 0, row_of, v.pieces.ids[np.maximum(row_of, 0)])
        weight = np.where(row_of < 0, _n_bytes(-1 - spelled) * v.byte_weight, v.pieces.weights[np.maximum(row_of, 0)])
        n_nodes = int(offset[-1])
        total = np.zeros(n_nodes)
        first_edge = np.concatenate([[0], np.cumsum(np.bincount(to, minlength=n_nodes))])
        bounds = first_edge[offset[1:]]
        for a, b in zip(bounds[:-1], bounds[1:]):
            t = to[a:b]
            first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
            x = total[frm[a:b]] + weight[a:b]
            top = np.maximum.reduceat(x, first)
            total[t[first]] = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, np.diff(np.append(first, b - a)))), first))
        share = np.cumsum(np.exp(total[frm] + weight - total[to]))
        before = np.concatenate([[0.0], share])[first_edge[to]]
        self.keys = to + np.minimum(share - before, 1.0)
        self.last = first_edge[1:] - 1
        self.log_total = total

    def sample(self, parts: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of one path per occurrence of a part, in order, and their number per occurrence."""
        who = np.argsort(self.final[parts], kind="stable")  # equal parts together, so that searches stay close
        node = self.final[parts[who]]
        steps, count = [], np.zeros(len(parts), np.int64)
        step = 0
        while len(who):
            with np.errstate(over="ignore"):
                draw = mix(seeds[who] + _U(step) * _U(0xD1342543DE82EF95))
            u = (draw >> _U(11)).astype(np.float64) * 2.0 ** -53
            edge = np.minimum(np.searchsorted(self.keys, node + u, side="right"), self.last[node])
            steps.append((who, self.piece[edge]))
            count[who] += 1
            node = self.frm[edge]
            going = node != self.start[parts[who]]
            node, who, step = node[going], who[going], step + 1
        out = np.empty(int(count.sum()), np.int64)
        end = np.cumsum(count)
        for back, (who, piece) in enumerate(steps):
            out[end[who] - 1 - back] = piece
        return out, count


def _parts(text: str) -> list[str]:
    """The text after a space, cut before each run of spaces."""
    return re.findall(" +[^ ]*", " " + text)


def _spread_bytes(pieces: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids with characters spelled as byte pieces, and the number of ids per piece."""
    bare = np.flatnonzero(pieces < 0)
    size = np.ones(len(pieces), np.int64)
    code = -1 - pieces[bare]
    size[bare] = _n_bytes(code)
    at = np.cumsum(size) - size
    out = np.repeat(np.maximum(pieces, 0).astype(np.int32), size)
    if len(bare):
        spelled = np.frombuffer("".join(map(chr, code)).encode(), np.uint8)
        out[np.repeat(at[bare] - np.cumsum(size[bare]) + size[bare], size[bare]) + np.arange(len(spelled))] = v.byte_ids[spelled]
    return out, size


def encode_texts(keys: list, texts: list[str | None], v: Vocabulary, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and the end of each text's ids."""
    number: dict[str, int] = defaultdict()
    number.default_factory = number.__len__
    occ, per_text, seeds = [], [], []
    for key, text in zip(keys, texts):
        split = [] if text is None else _parts(text)
        occ.append(np.fromiter(map(number.__getitem__, split), np.int64, len(split)))
        per_text.append(len(split))
        base = _U(xxhash.xxh64_intdigest(f"{seed}:{key}".encode()))
        with np.errstate(over="ignore"):
            seeds.append(mix(base + np.arange(len(split), dtype=np.uint64) * _BASE))
    pieces, count = Lattices(list(number), v).sample(np.concatenate(occ), np.concatenate(seeds))
    ids, size = _spread_bytes(pieces, v)
    ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(count)])]
    return ids, ends[np.cumsum(per_text)]


def decode_ids(ids: np.ndarray, v: Vocabulary) -> str:
    """The text of one row's ids, without the space before it."""
    return b"".join(map(v.decoded.__getitem__, ids.tolist()))[1:].decode()


def encode(df: DataFrame, key_col: str = "doc_id", text_col: str = "text", out: str = "ids", seed: int = 0, alpha: float = 1.0,
           model_file: str = MODEL, decoded: str | None = None) -> DataFrame:
    """Add a column of sampled piece ids (array<int>) to every row; with ``decoded``, also one of the text that they decode to.

    A row's ids depend on its text, its key (as text; NULL is a key like any other), ``seed`` and ``alpha``
    (weights to the power alpha: 0 draws all segmentations alike) alone; repeated rows get equal ids. NULL text
    gives NULL ids; an empty text is the space piece alone, as every text begins with a space mark that decoding takes
    away. A long text is encoded whole, in memory linear in its length. All other columns pass through; those named like
    ``out`` or ``decoded`` are replaced. An empty table stays empty. The vocabulary (bounded by the model) is all that is
    sent to the tasks; every row is encoded, and decoded, where it is read.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(Vocabulary(model_file, alpha))
    base = df.drop(out, *([decoded] if decoded else []))
    schema = T.StructType([*base.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType())),
                           *([T.StructField(decoded, T.StringType())] if decoded else [])])
    names = base.columns

    def run(batches):
        v = shared.value
        for batch in batches:
            a = 0
            while a < batch.num_rows:
                b, chars, keys, texts = a, 0, [], []
                while b < batch.num_rows and chars < SLICE_CHARS:
                    texts.append(batch.column(names.index(text_col))[b].as_py())
                    keys.append(batch.column(names.index(key_col))[b].as_py())
                    chars += len(texts[-1] or "")
                    b += 1
                ids, ends = encode_texts(keys, texts, v, seed)
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                mask = [t is None for t in texts]
                made = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()), mask=pa.array(mask))]
                if decoded:
                    back = [None if none else decode_ids(ids[x:y], v) for x, y, none in zip(offsets[:-1], offsets[1:], mask)]
                    made.append(pa.array(back, pa.string()))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in part.columns] + made, names=schema.names)
                a = b

    return base.mapInArrow(run, schema)


def decode(df: DataFrame, ids_col: str = "ids", out: str = "decoded", model_file: str = MODEL) -> DataFrame:
    """Add the text of every row's ids; the exact inverse of ``encode``. NULL ids give NULL; a column named like ``out`` is
    replaced, others pass through; an empty table stays empty."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(Vocabulary(model_file))
    base = df.drop(out)
    names = base.columns
    schema = T.StructType([*base.schema.fields, T.StructField(out, T.StringType())])

    def run(batches):
        v = shared.value
        for batch in batches:
            column = batch.column(names.index(ids_col))
            texts = [decode_ids(x.values.to_numpy(zero_copy_only=False), v) if x.is_valid else None for x in column]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, out])

    return base.mapInArrow(run, schema)
