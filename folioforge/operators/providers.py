"""What the engine asks models for: answers, embeddings, pages read by OCR. Providers are picklable objects; those here need no network and always answer alike."""

from __future__ import annotations

import hashlib
import json
from typing import Protocol

import numpy as np


class LlmProvider(Protocol):
    def answer(self, prompt: str, image_link: str | None, attempt: int) -> str: ...


class EmbeddingProvider(Protocol):
    def embed(self, texts: list[str]) -> list[list[float]]: ...


class OcrProvider(Protocol):
    def pages(self, pdf: bytes, dpi: int, max_pages: int | None, crop_top: int) -> list[tuple[str, int, int]]:
        """raw HTML, width and height of each page"""


class EchoLlm:
    """A stand-in: quotes the beginning of the prompt as the JSON that is asked for."""

    def __init__(self, key: str = "table_summary", as_list: bool = True):
        self.key, self.as_list = key, as_list

    def answer(self, prompt: str, image_link: str | None, attempt: int) -> str:
        said = " ".join(prompt.split())[:200]
        return json.dumps({self.key: [said] if self.as_list else said}, ensure_ascii=False)


class HashedWords:
    """A stand-in: counts of words in hashed places, scaled to length one."""

    def __init__(self, size: int = 64):
        self.size = size

    def embed(self, texts: list[str]) -> list[list[float]]:
        out = []
        for text in texts:
            v = np.zeros(self.size)
            for word in text.lower().split():
                h = hashlib.blake2b(word.encode(), digest_size=8).digest()
                v[int.from_bytes(h[:4], "little") % self.size] += 1 if h[4] & 1 else -1
            length = np.sqrt(v @ v)
            out.append((v / length if length else v).tolist())
        return out
