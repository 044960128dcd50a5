import random

import pytest

from tidemark.llm.common import prepare_texts


@pytest.fixture(autouse=True)
def small_batches(spark):
    prepare_texts(spark)


@pytest.fixture
def rng():
    return random.Random(11)
