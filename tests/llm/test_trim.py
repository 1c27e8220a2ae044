"""Workers live on into later stages, which do not carry the encoder of an earlier one."""

import pytest

from ingot.llm import common, tokens

public_tokenizers = pytest.importorskip("public_tokenizers")


def test_trim_drops_what_an_earlier_stage_kept():
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    tokens.encoder(path, 2)("some words")
    assert ("encoder", path, 2) in common.worker_cache()
    common.trim()
    assert not [k for k in common.worker_cache() if isinstance(k, tuple)]
