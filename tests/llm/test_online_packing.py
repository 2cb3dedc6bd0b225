"""Online packing: ids against the tokenizer, placement against a plain sum of squares."""
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidewater.llm import online_packing as p
from tidewater.llm.byte_ids import ByteIds

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " \n", "Hello, World! don't you're x'S", "a  b c\u0085d  \nx   \nx  　  \ny　 z",
       "<|endoftext|> x<|startoftext|>y <|end <|endoftext|>\n<|endoftext|>", "é ≠ ̣́", "日本語 テスト。😀👍🏽 ok",
       "\x00\x1c a\x1fb \x1c\n x", "—. “quoted” it’s _x_ a_b 'tis", "x" * 9000, "'s 't 're 'll", "  two  spaces \n\n\nlines \n\n x\t\ty",
       "Ünïcödé ÀÉÎ ß ÿ", "tail... (paren)\nNext\nLine. \tTab\rcr\x0bvt\x0cff end\n", "a ", "\n word", "\t word", "end\r\nnext\r\n\r\nx"]


def test_ids_equal_the_tokenizers(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()] + ODD
    r = random.Random(1)
    alphabet = " \n\t\r ab'.,s1é  \u0085日<|"
    texts += ["".join(r.choice(alphabet) for _ in range(r.randint(0, 40))) for _ in range(5000)]
    t, ids_of = Tokenizer.from_file(PATH), ByteIds(PATH)
    for some in (texts, texts[::-1], ODD):
        ids, bounds = ids_of.encode(pa.array(some, pa.string()))
        for i, text in enumerate(some):
            assert ids[bounds[i]: bounds[i + 1]].tolist() == t.encode(text or "", add_special_tokens=False).ids, text


def test_units_share_their_letters():
    ids_of = ByteIds(PATH)
    ids_of._worker().forget()
    ids_of.encode(pa.array(["a house, house. house; house\nhouse, (house)"]))
    # of the first and the second line, " house", the line's end, three tails, and a unit that begins with a mark
    assert len(ids_of._worker().known) == 8


def power(n):
    return n & (n - 1) == 0


def plain(lengths, capacity):
    """Levels chosen one by one, the whole sum of squares computed for each choice."""
    count, chosen = Counter(), []

    def squares(c):
        return sum(n * n for level, n in c.items() if level < capacity and not power(level))

    for x in lengths:
        best = None
        for level in [0] + [h for h in count if count[h]]:
            if level + x > capacity:
                continue
            after = Counter(count)
            if level:
                after[level] -= 1
            after[level + x] += 1
            rank = (squares(after), -level)
            if best is None or rank < best[0]:
                best = (rank, level, after)
        chosen.append(best[1])
        count = best[2]
        count[capacity] = 0
    return chosen


@pytest.mark.parametrize("seed", range(20))
def test_levels_minimise_the_sum_of_squares(seed):
    r = random.Random(seed)
    capacity = r.choice([8, 16, 30, 64])
    lengths = [r.randint(1, capacity - 1) for _ in range(r.randint(1, 150))]
    stream, got = p.Stream(capacity), []
    for i, x in enumerate(lengths):
        got.append(stream.level_for(x))
        stream.place(p.Piece(i, 0, np.zeros(x, "<u4"), x))
    assert got == plain(lengths, capacity)


@pytest.mark.parametrize("seed", range(20))
def test_closing_pads_nothing(seed):
    r = random.Random(100 + seed)
    lengths = [r.randint(1, 60) for _ in range(r.randint(0, 200))]
    stream, done = p.Stream(64), []
    for i, x in enumerate(lengths):
        done += stream.place(p.Piece(i, 0, np.arange(x).astype("<u4"), x))
    done += stream.close()
    assert not stream.tokens and not stream.close()
    parts = defaultdict(list)
    for w in done:
        assert w.fill == sum(len(q.ids) for q in w.pieces) and power(w.fill)
        for q in w.pieces:
            parts[q.doc].append((q.start, q.ids))
    for i, x in enumerate(lengths):
        assert np.concatenate([ids for _, ids in sorted(parts[i], key=lambda s: s[0])]).tolist() == list(range(x))
    assert sum(w.fill < 64 for w in done) <= 6 + len(lengths) // 3


def check(got, texts, capacity=2048, end_id=1):
    """Pieces cover each document once, lie gapless in their sequences; returns the padding."""
    t = Tokenizer.from_file(PATH)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for doc, text in texts.items():
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [end_id], "<u4")
        at = 0
        for start, length, crc, total in sorted(pieces[doc]):
            assert start == at and total == len(ids) and length > 0
            assert crc == zlib.crc32(ids[start: start + length].tobytes())
            at += length
        assert at == len(ids)
    padding = 0
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
        padding += 0 if power(at) else capacity - at
    return padding


@pytest.mark.parametrize("open_tokens", [p.OPEN_TOKENS, 5000])
def test_documents(spark, open_tokens):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += list(enumerate(ODD, 9000)) + [(None, "x"), (9100, "long word " * 5000)]
    df = spark.createDataFrame([(7, i, t, "s") for i, t in rows], "length int, doc_id bigint, text string, start string")
    got = p.pack_online(df.repartition(3), PATH, open_tokens=open_tokens).collect()
    assert check(got, dict(rows)) == 0
    whole = Counter(r.doc_id for r in got)
    if open_tokens == p.OPEN_TOKENS:  # most documents that fit stay in one piece
        short = [r.doc_id for r in got if r.doc_tokens <= 2048]
        assert sum(whole[d] == 1 for d in short) > 0.6 * len(set(short))


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c")] * 50, "doc_id bigint, text string").coalesce(1)
    got = p.pack_online(df, PATH).collect()
    assert sum(r.length for r in got) == 200 and {r.doc_tokens for r in got} == {4}
    assert p.pack_online(df.limit(0), PATH).count() == 0
