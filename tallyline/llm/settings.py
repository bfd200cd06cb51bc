"""Production parameters of the registered queries and of the corpus pipeline."""

from __future__ import annotations

import public_tokenizers

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
MIX_WEIGHTS = {"src0": 2.0}  # every other source has weight 1
MIN_SITES = 10
PASSAGE_SITES, PASSAGE_WORDS = 3, 30
TOXIC = 0.5
LEAK_WORDS = 10
