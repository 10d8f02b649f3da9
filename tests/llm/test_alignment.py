"""Token alignment against plain loops over the tokenizers' own files."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from formline.llm import alignment, packing

SCHEMA = "doc_id long, text string, copies long, text_key string, pairs long, pair long, count long, n_a long"


def table_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "k", 2, 3, 4, 5) for r in rows], SCHEMA)


def byte_of_character():
    """The byte that each character of a byte-level entry stands for."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@pytest.fixture(scope="module")
def by_file():
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    out = [tuple(r) for r in given] + [(5000 + i, "the same text again, and again") for i in range(300)]
    out += [
        (None, "x"), (None, None), (1, ""), (1, " "), (7, "  two  spaces \n\t<|endoftext|> </s><s>"), (9, " " * 5000), (10, "ab" * 4000),
        (8, "▁ ▂ 😀😀👩‍👩‍👧 漢字仮名 é é  ﬁ Å ﻿"), (11, "\r\n\r\n \xa0 　​ zero \x00 \x01"), (12, "word " * 20_000),
    ]
    signs = ["漢", "😀", " ", "a", "é", "\n", "Zq", "1", "the ", " of", "́", "▁", "\r", " ", "'s", "ǅ"]
    return out + [(6000 + i, "".join(rng.choice(signs) for _ in range(rng.randint(1, 80)))) for i in range(300)]


@pytest.fixture(scope="module")
def expected(rows, by_file):
    first, second = by_file
    byte, docs, count = byte_of_character(), [], collections.Counter()
    for doc_id, text in rows:
        a, b = (first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)) if text else ([], [])
        whole = b" " + (text or "").encode()
        left = [bytes(byte[c] for c in first.id_to_token(i)) for i in a]
        right = [bytes([int(second.id_to_piece(i)[3:-1], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
        groups = []
        if text and b"".join(left) == whole == b"".join(right):
            ends = [np.cumsum([len(p) for p in side]).tolist() for side in (left, right)]
            at = [0, 0]
            for end in sorted(set(ends[0]) & set(ends[1])):
                group = ([], [])
                for side, ids in enumerate((a, b)):
                    while at[side] < len(ids) and ends[side][at[side]] <= end:
                        group[side].append(ids[at[side]])
                        at[side] += 1
                groups.append(group)
        docs.append((doc_id, groups))
        count.update({(x, y) for g, h in groups for x in g for y in h})
    top = collections.Counter()
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = []
    for doc_id, groups in docs:
        links = [(x, y) for g, h in groups for x in g for y in h]
        named = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((
            doc_id, sum(len(g) for g, _ in groups), sum(len(h) for _, h in groups), len(groups), len(links),
            sum(count[k] == top[k[0]] for k in links), sum(count[k] for k in links),
            hashlib.sha256(named.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=str)


@pytest.mark.parametrize("frequent, hot", [(1_000_000, 1000), (50, 0), (0, 1)])
def test_measures_as_from_plain_loops(spark, rows, expected, frequent, hot):
    """Counts from the table of frequent pairs, from the join of the others, and from both."""
    found = alignment.align_documents(table_of(spark, rows).repartition(4), frequent=frequent, hot_texts=hot)
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected


def test_no_documents(spark):
    assert alignment.align_documents(table_of(spark, [])).collect() == []


def test_wide_groups_count_as_narrow_ones():
    a, b = np.array([5, 5, 9]), np.array([2, 2, 2, 7])
    pairs, weights = alignment._wide_pairs(a, b)
    plain = collections.Counter(x * alignment.PAIR + y for x in a.tolist() for y in b.tolist())
    assert dict(zip(pairs.tolist(), weights.tolist(), strict=True)) == plain


def test_both_forms_of_the_first_vocabulary_give_the_same_ids(rows, by_file):
    texts = [t for _, t in rows if t]
    mine = alignment.tokenizers()[0].encode(texts)
    assert mine == [e.ids for e in by_file[0].encode_batch([" " + t for t in texts], add_special_tokens=False)]
    special = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    packed = [packing._encoder(packing.vocabulary_path()).encode(t, allowed_special="all") for t in texts]
    assert packed == [e.ids for e in special.encode_batch(texts, add_special_tokens=False)]
