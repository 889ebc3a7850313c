import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from docs import EDGE, frame, prose
from spendlens.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def digests_of(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    back = library.decode(ids, skip_special_tokens=False)
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(back.encode()).hexdigest())


def test_edge_documents_equal_the_library(spark, library):
    rows = EDGE + [(100 + i, prose(1, 300) + "\n" + prose(i, 30)) for i in range(20)]
    got = bpe.op1_encode_decode(frame(spark, rows), PATH).collect()
    assert sorted(((r.doc_id is None, r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == \
        sorted(((i is None, i), *digests_of(library, t)) for i, t, *_ in rows)


def test_random_text_joins_are_repaired(library):
    r = random.Random(3)
    pool = list("ab  \n\t.,'12é中ß") + ["'s", " the", "tion", "<|endoftext|>", "　", "\x85", "!!", "ÀÉ", "\x00"]
    texts = ["".join(r.choice(pool) for _ in range(r.choice([0, 5, 200, 1500]))) for _ in range(300)]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    got = bpe.encoder(PATH, {}).encode(data, offsets)
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert got == want


def test_shared_passages_are_encoded_once_and_reused(spark, library):
    passage = prose(1, 400)
    docs = frame(spark, [(i, f"start {i} {passage} end {i}") for i in range(6)])
    shared = bpe.shared_chunks(docs, PATH)
    assert sum(map(len, shared)) > 0.6 * len(passage)
    for chunk, (head, core, tail) in shared.items():
        assert chunk.startswith(head) and chunk.endswith(tail)
        if core is not None:
            middle = chunk[len(head):len(chunk) - len(tail)].decode()
            assert np.frombuffer(core, "<u4").tolist() == library.encode(middle, add_special_tokens=False).ids


def test_chunks_of_a_passage_do_not_depend_on_what_precedes_it():
    passage = prose(2, 500).encode()

    def chunks(raw):
        data = np.frombuffer(raw, np.uint8)
        ends = bpe.chunk_ends(data, np.array([0, len(raw)])).tolist()
        return {raw[a:b] for a, b in zip([0, *ends[:-1]], ends)}

    alone, inside = chunks(passage), chunks(b"another beginning " + passage)
    assert len(alone & inside) >= len(alone) - 2


def test_decode_of_broken_bytes_and_null_ids(spark, library):
    half = library.encode("é", add_special_tokens=False).ids  # one token or two
    odd = [library.token_to_id("Ã"), 50256]
    rows = spark.createDataFrame([(1, half), (2, odd), (3, None), (4, [])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in bpe.decode(rows, PATH).collect()}
    assert got == {1: "é", 2: library.decode(odd, skip_special_tokens=False), 3: "", 4: ""}


def test_empty_table(spark):
    assert bpe.op1_encode_decode(frame(spark, []), PATH).collect() == []
