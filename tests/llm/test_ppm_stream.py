import numpy as np
import pyarrow as pa

from riskloom.llm import ppm as P


def test_documents_pass_by_their_answers_one_batch_at_a_time():
    """A task gives the rows of a batch of documents before it reads the next, whatever the chunk holds."""
    texts = [b"a b", b"b", b""]
    grams = []
    for t in texts:
        words = P.split(pa.array([t], pa.binary()), P.NOT_WHITE, lower=True)
        text, places, _ = P.stream(words)
        grams.append(P.grams(text, places))
    keys = np.unique(np.concatenate(grams)).view(np.int64)
    words = P.split(pa.array([b"a b"], pa.binary()), P.NOT_WHITE, lower=True)
    hashed = P.hashes(words.data, words.starts, words.ends).view(np.int64)
    read = []

    def batch(place, key, value, ids, text):
        n = len(key)
        read.append(place)
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, place, np.int32)), pa.array(key, pa.int64()), pa.array(value, pa.float64()),
                                           pa.array(ids, pa.int64()), pa.array(text, pa.binary())], ["place", "key", "value", "id", "text"])

    def batches():
        for chunk in (0, 1):
            half = len(keys) // 2
            for part in (keys[:half], keys[half:]):
                yield batch(chunk * 4 + P.GRAM, part, np.full(len(part), -1.0), [None] * len(part), [None] * len(part))
            yield batch(chunk * 4 + P.WORD, [0, *hashed.tolist()], [2.0, 3.0, 0.0], [None] * 3, [None] * 3)
            for i, t in enumerate(texts):
                yield batch(chunk * 4 + P.DOCUMENT, [i % 2], [0.0], [chunk * 10 + i], [t])

    found = []
    for out in P._score_chunks(5, 2)(batches()):
        found += [(len(read), *row.values()) for row in out.to_pylist()]
    assert [r[0] for r in found] == [4, 5, 6, 10, 11, 12]
    assert [r[1:6] for r in found[:3]] == [(0, False, 3, 2, 5), (1, True, 2, 1, 5), (2, False, 1, 1, 5)]
    assert np.allclose([r[7] * P.LN10 for r in found[:3]], [-4, -2, -1]) and [r[6:] for r in found[:3]] == [r[6:] for r in found[3:]]
