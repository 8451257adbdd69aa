"""Shuffle sizes follow the inputs and are put back."""

from __future__ import annotations

import pytest

from pricefold.session import shuffles_sized_for

NAME = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_shuffles_follow_the_input(spark):
    wide, narrow = spark.range(0, 100, 1, 40), spark.range(0, 100, 1, 1)
    with shuffles_sized_for(wide, narrow):
        assert spark.conf.get(NAME) == "82"
        with shuffles_sized_for(narrow):
            assert spark.conf.get(NAME) == "82"
    assert spark.conf.get(NAME, None) is None
    with pytest.raises(KeyError), shuffles_sized_for(narrow):
        assert spark.conf.get(NAME) == spark.conf.get("spark.sql.shuffle.partitions")
        raise KeyError
    assert spark.conf.get(NAME, None) is None
