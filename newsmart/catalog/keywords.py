"""A stand-in for a model, with which the queries run without a network."""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Callable, Sequence

from pyspark import cloudpickle

from newsmart.operators.annotate import Complete

# Workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def keyword_annotator(bullish: Sequence[str], bearish: Sequence[str]) -> Callable[[], Complete]:
    """A model stand-in that counts words, so the job runs without a network.

    Reads the whole prompt, case ignored.  The label is the side with more
    words, mixed on a tie, neutral without any; confidence is that side's share.
    """

    def pattern(words: Sequence[str]) -> re.Pattern[str]:
        return re.compile(r"\b(?:" + "|".join(map(re.escape, words)) + r")\b")

    def make() -> Complete:
        up, down = pattern(bullish), pattern(bearish)

        def answer(prompt: str) -> str:
            text = prompt.lower()
            risen, fallen = up.findall(text), down.findall(text)
            ups, downs, met = len(risen), len(fallen), {*risen, *fallen}
            total = ups + downs
            if not total:
                label, share = "neutral", 1.0
            elif ups == downs:
                label, share = "mixed", 0.5
            else:
                label, share = ("bullish" if ups > downs else "bearish"), max(ups, downs) / total
            reply = {
                "summary": prompt.split("\n", 1)[0],
                "sentiment": label,
                "sentiment_confidence": round(share, 6),
                "key_topics": [w for w in (*bullish, *bearish) if w in met],
            }
            return json.dumps(reply, ensure_ascii=False)

        return lambda prompts: [answer(p) for p in prompts]

    return make
