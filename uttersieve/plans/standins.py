"""Deterministic models for the named queries, the tests and the benchmark.

No part of the engine uses them: its jobs take the caller's factory.
"""

import numpy as np

from uttersieve.schema import PUNCTUATION


class SpokenTextModel:
    """Hears what it is told.

    Its payload is ``"kind:text"`` and it returns the text as a model of that
    kind would: with quotes, with blanks, without the first character, not at
    all, or without punctuation.
    """

    def __init__(self, name):
        self.name = name
        self._marks = str.maketrans("", "", PUNCTUATION)

    def __call__(self, payloads, languages):
        return [self._say(p) for p in payloads]

    def _say(self, payload):
        kind, text = payload.split(":", 1)
        if kind == "0":
            return f'"{text}!"'
        if kind == "1":
            return f"  {text} "
        if kind == "2":
            return text[1:]
        if kind == "3":
            raise TimeoutError("timeout")
        return text.translate(self._marks)


class SpokenLinesModel(SpokenTextModel):
    """The same, one segment per line of the text."""

    def _say(self, payload):
        kind, text = payload.split(":", 1)
        return [super(SpokenLinesModel, self)._say(f"1:{line}") for line in text.split("\n")]


class FrameModel:
    """A stand-in encoder: 300 frames of two numbers from the samples."""

    def __init__(self, name):
        self.name = name

    def __call__(self, payloads, languages):
        at = np.arange(300)[:, None] + np.arange(2)[None, :]
        return [np.asarray(p, dtype=np.float32)[at % len(p)].tolist() for p in payloads]
