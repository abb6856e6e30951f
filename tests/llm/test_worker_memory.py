"""What Python workers and executors hold on to between the stages of a pipeline."""

import weakref

from tablejobs.llm import jaccard
from tablejobs.llm.bpe import tokenizer, vocabulary
from tablejobs.llm.textbatch import kept


def test_a_worker_keeps_what_one_operator_needs():
    """The tokenizer's caches stay for more tasks of its own and go when the join's begin."""
    first = weakref.ref(tokenizer(*vocabulary()))
    assert first() is not None and tokenizer(*vocabulary()) is first()
    hasher = jaccard._hasher()
    assert first() is None and jaccard._hasher() is hasher
    assert kept("other", list) == [] and jaccard._hasher() is not hasher
