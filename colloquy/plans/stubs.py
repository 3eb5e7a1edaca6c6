"""Deterministic predictors used by the registered generation query and tests.

They stand in for a model client: a factory builds the predictor once per task.
"""

from __future__ import annotations


def echo_last_turn_factory():
    """Predictor that answers with the text of the last prompt turn."""

    def predict(messages: list[dict], max_new_tokens: int) -> str:
        return (messages[-1].get("content") or "") if messages else ""

    return predict


def echo_last_turn_batch_factory():
    single = echo_last_turn_factory()

    def predict_batch(batch: list[list[dict]], max_new_tokens: int) -> list[str]:
        return [single(m, max_new_tokens) for m in batch]

    return predict_batch


def failing_batch_factory(bad_content: str):
    """Factory of a batch predictor that fails any batch containing ``bad_content``
    (exercises the per-row fallback and error reporting)."""

    def factory():
        def predict_batch(batch: list[list[dict]], max_new_tokens: int) -> list[str]:
            if any(m and m[-1].get("content") == bad_content for m in batch):
                raise RuntimeError("boom")
            return [(m[-1].get("content") or "") if m else "" for m in batch]

        return predict_batch

    return factory


def fours_factory():
    """Tokenizer stub: pieces of at most four characters."""

    def encode(text: str) -> list[str]:
        return [text[i : i + 4] for i in range(0, len(text), 4)]

    return encode
