"""Settings, as plain dataclasses on the driver."""

from __future__ import annotations

from dataclasses import dataclass

# Special tokens and their ids.
SPECIAL_TOKENS = {"<PAD>": 0, "<UNK>": 1, "<BOS>": 2, "<EOS>": 3}
WORDPIECE_SPECIAL_TOKENS = {**SPECIAL_TOKENS, "[CLS]": 4, "[SEP]": 5, "[MASK]": 6}
WORD_SPECIAL_TOKENS = {"<UNK>": 0}
UNK_TOKEN = "<UNK>"

# Prompt templates.
SOLUTION_TEMPLATE = "<|solution|>\n{successful_previous_attempt}\n<|/solution|>\n"
FEEDBACK_TEMPLATE = "<|feedback|>\n{feedback_raw}\n<|/feedback|>\n"
REPROMPT_TEMPLATE = (
    "{prompt}\n\n"
    "Here is a previous attempt and feedback:\n"
    "{solution}"
    "{feedback}"
    "Now, try again with this knowledge.\n"
)


# The defaults of all settings below.


@dataclass(frozen=True)
class Reprompting:
    success_threshold: float = 1.0
    skip_own_success: bool = True
    remove_thinking: bool = True
    include_feedback: bool = True
    feedback_only_without_solution: bool = True
    max_chars: int = 10240
    truncation: str = "right"
    solution_template: str = SOLUTION_TEMPLATE
    feedback_template: str = FEEDBACK_TEMPLATE
    reprompt_template: str = REPROMPT_TEMPLATE


@dataclass(frozen=True)
class Distillation:
    alpha: float = 0.5
    top_k: int | None = None
    add_tail: bool = True
    weight_clip: float | None = 2.0


@dataclass(frozen=True)
class LossWeights:
    policy: float = 1.0
    distillation: float = 1.0
    reference_kl: float = 0.01
