"""Bands that can't reach the target are refused."""

import pytest

from voltframe.llm.ngram_join import TARGET, depth_for


def test_no_target_is_missed_silently():
    assert depth_for(0.8, TARGET) == 4 and depth_for(0.5, TARGET) == 1
    with pytest.raises(ValueError):
        depth_for(0.3, TARGET)
