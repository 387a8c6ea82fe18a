import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import token_counts

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
PARTS = ["a", " ", "  ", "\n", "\t", "\r\n", "\xa0", " ", "\x85", "\x1c", "é", "Ж", "中", "1", "٣", "'s", "'ll", "!", "😀",
         "<|endoftext|>", "​", "́", "e", "word", " the", ".", "\x00", "﻿", "'", "don't", "\u180e", "\u2028", "\u3000", "\x1f", "\x0b", "²", "Ⅷ"]


def test_pretokens_sum_to_the_library_count():
    t = Tokenizer.from_file(PATH)
    split, rnd = token_counts.splitter(t), random.Random(5)
    for _ in range(20000):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 14)))
        n = sum(token_counts.pieces(t, p) for p in split(text))
        assert n == len(t.encode(text, add_special_tokens=False).ids), repr(text)


@pytest.mark.parametrize("hot", [0, 300, token_counts.HOT])
def test_documents_match_the_library(make, documents, hot):
    t = Tokenizer.from_file(PATH)
    docs = documents.limit(60).unionByName(make([(1001, None), (1002, ""), (1003, "x <|endoftext|> y"), (1003, "x <|endoftext|> y"), (None, "ab " * 40000),
                                                 (1003, "another text")])).selectExpr("*", "1 AS p", "2 AS n", "3 AS id")
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in token_counts.count(docs, PATH, hot=hot).collect()), key=str)
    want = sorted(((r["doc_id"], len((r["text"] or "").encode()), len(t.encode(r["text"] or "", add_special_tokens=False).ids)) for r in docs.collect()), key=str)
    assert got == want


def test_empty(make):
    assert token_counts.count(make([]), PATH).count() == 0
