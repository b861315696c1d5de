import hashlib
import random
from collections import Counter

import cases
import numpy as np
import pytest

from tidemark.llm import alignment, queries


def tokens():
    """Both libraries as their README shows them, with token bytes by a plain rule."""
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    alphabet = alignment.byte_alphabet()

    def both(text):
        if not text:
            return [], []
        want = (" " + text).encode()
        left = [
            (i, bytes(alphabet[c] for c in a.id_to_token(i)))
            for i in a.encode(" " + text, add_special_tokens=False).ids
        ]
        right = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            byte = piece.startswith("<0x") and b.is_byte(i)
            right.append((i, bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode()))
        if any(b"".join(x for _, x in side) != want for side in (left, right)):
            return [], []
        return left, right

    return both


def ends_of(side):
    out, at = [], 0
    for _, data in side:
        at += len(data)
        out.append(at)
    return out


def brute(rows):
    both = tokens()
    texts = [both(text) for _, text in rows]
    links, counts = [], Counter()
    for left, right in texts:
        ends_a, ends_b = ends_of(left), ends_of(right)
        other = {e: right[j][0] for j, e in enumerate(ends_b)}
        mine = [(left[i][0], other[e]) for i, e in enumerate(ends_a) if e in other]
        links.append(mine)
        counts.update(mine)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for (doc_id, _), (left, right), mine in zip(rows, texts, links):
        ends_a, ends_b = ends_of(left), ends_of(right)
        common = set(ends_a) & set(ends_b)
        written = []
        for side, ends in ((left, ends_a), (right, ends_b)):
            signed = "".join(f"{t}{';' if e in common else ','}" for (t, _), e in zip(side, ends))
            written.append(signed.split(";")[:-1])
        groups = [f"{a}|{b}" for a, b in zip(*written)]
        joined = ";".join(groups)
        out.append(
            (
                str(doc_id),
                len(left),
                len(right),
                len(groups),
                len(mine),
                sum(counts[p] == best[p[1]] for p in mine),
                sum(counts[p] for p in mine),
                hashlib.sha256(joined.encode()).hexdigest() if joined else "",
            )
        )
    return sorted(out)


def found(frame):
    return sorted((str(r[0]), *tuple(r)[1:]) for r in frame.collect())


TEXTS = [
    "Hello  world\n ok",
    "a\x00b",
    "ﬁ é 漢😀 naïve café",
    "<s> hi </s><unk> <|endoftext|> end",
    " lead and trail ",
    "tab\tx",
    "   ",
    "\n",
    "x▁y",
    "",
    None,
    "x" * 5000,
    " " * 4000 + "a",
    "<0x41> A <0x0A>",
    "ＦＵＬＬ width ½ ²",
]


def test_against_the_definition(spark):
    drawn = random.Random(1)
    texts = TEXTS + [cases.prose(i, drawn.randint(1, 200)) for i in range(20)]
    texts += ["".join(drawn.choices("aé漢 \n\t😀zq,.", k=drawn.randint(1, 60))) for _ in range(60)]
    frame = cases.documents(spark, texts)
    assert found(alignment.digests(frame)) == brute(list(enumerate(texts)))


@pytest.mark.parametrize("seed", range(4))
def test_gallop_finds_what_bisection_finds(seed):
    drawn = np.random.default_rng(seed)
    for _ in range(50):
        other = np.unique(drawn.integers(0, 300, drawn.integers(1, 200)))
        driver = np.unique(drawn.integers(-5, 310, drawn.integers(1, 60)))
        guess = drawn.integers(-3, len(other) + 3, len(driver))
        assert (alignment.gallop(driver, other, guess) == np.searchsorted(other, driver)).all()


def test_common_ends_of_several_texts():
    drawn = np.random.default_rng(9)
    a, b, counts_a, counts_b, base = [], [], [], [], 0
    for _ in range(40):
        length = int(drawn.integers(1, 60))
        for ends, counts in ((a, counts_a), (b, counts_b)):
            mine = np.unique([*drawn.integers(1, length + 1, drawn.integers(0, length)), length])
            ends.append(mine + base)
            counts.append(len(mine))
        base += length
    a, b = np.concatenate(a), np.concatenate(b)
    in_a, in_b = alignment.common_ends(a, np.array(counts_a), b, np.array(counts_b))
    assert (a[in_a] == np.intersect1d(a, b)).all() and (b[in_b] == a[in_a]).all()
    one, none = np.array([3]), np.array([0])
    assert len(alignment.common_ends(one, np.array([1]), np.empty(0, np.int64), none)[0]) == 0


def test_overlaps(spark):
    texts = ["Hello  world\n ok, naïve café 漢字", None, "unbelievable tokenization", "a"]
    frame = cases.documents(spark, texts)
    aligned = alignment.align(frame)
    both = tokens()
    for row in alignment.overlaps(aligned).collect():
        left, right = both(texts[row.doc_id])
        ends_a, ends_b = ends_of(left), ends_of(right)
        starts_a, starts_b = [0, *ends_a[:-1]], [0, *ends_b[:-1]]
        for i in range(len(left)):
            shares = [
                j for j in range(len(right)) if starts_b[j] < ends_a[i] and ends_b[j] > starts_a[i]
            ]
            assert (row.first_b[i], row.after_b[i]) == (shares[0], shares[-1] + 1)
        assert len(row.first_b) == len(left)


def test_linked_pairs_stay_below_the_bound(spark, folder):
    """Linked ids are suffixes of each other, so the broadcast cannot grow with the corpus."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left, right = alignment.sides()
    rows = alignment.pair_counts(alignment.summaries(docs)).collect()
    for row in rows:
        a, b = left.bytes[row.pair // 32000], right.bytes[row.pair % 32000]
        assert a.endswith(b) or b.endswith(a)
    assert len(rows) <= alignment.pair_bound() < 1_000_000


def test_awkward_rows(spark):
    frame = cases.awkward(spark)
    rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
    assert found(alignment.digests(frame)) == brute(rows)


def test_empty_table(spark):
    result = alignment.digests(cases.empty(spark))
    assert result.count() == 0 and result.columns[0] == "doc_id"


def test_query_against_the_definition(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found(queries.QUERIES["op13_galloping_alignment"](spark, folder)) == brute(rows)
