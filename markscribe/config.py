"""Engine configuration and canonical questions."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


class SheetError(Exception):
    """Base of the engine's own errors."""


class SheetFileError(SheetError):
    """A sheet that cannot be read."""


class QuestionFormatError(SheetError):
    """A question file without a usable question."""


@dataclass(frozen=True)
class Question:
    """A canonical question; ``question_id`` is Q and its number."""

    number: int
    question_text: str = ""
    max_marks: int | None = None
    model_answer: str | None = None

    @property
    def question_id(self) -> str:
        return f"Q{self.number}"


@dataclass(frozen=True)
class EngineConfig:
    """Folders, thresholds, budgets and the model's settings; ``from_environment`` reads MARKSCRIBE_<FIELD>.

    ``memo_path`` names a folder that keeps replies from batch to batch (none: within a batch only).
    """

    input_dir: str = "input"
    output_dir: str = "output"
    logs_dir: str = "logs"
    model_answers_path: str = "model_answers.md"
    encoding: str = "utf-8"
    exam_id: str = ""
    adjudicate: bool = False
    confidence_threshold: float = 0.85
    review_threshold: float = 0.60
    max_calls: int = 64
    max_boundary_calls: int = 32
    context_chars: int = 3000
    prefix_chars: int = 120
    excerpt_chars: int = 150
    memo: bool = True
    memo_path: str = ""
    model: str = ""
    endpoint: str = ""
    device: str = "auto"
    max_input_tokens: int = 4096
    max_new_tokens: int = 64
    temperature: float = 0.0
    quantize: bool = True
    compute_dtype: str = "float16"

    @classmethod
    def from_environment(cls, env=os.environ) -> EngineConfig:
        found = {"adjudicate": True}  # a configuration by environment adjudicates unless told otherwise
        for f in fields(cls):
            if (value := env.get(f"MARKSCRIBE_{f.name.upper()}")) is not None:
                kind = type(f.default)
                found[f.name] = value.lower() in ("1", "true", "yes") if kind is bool else kind(value)
        return cls(**found)

    @property
    def quantization(self) -> str:
        return "4bit" if self.quantize and self.model else "none"
