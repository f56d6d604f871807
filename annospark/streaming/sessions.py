"""Live turns and conversations as the batch forms define them, whatever order and batches the segments arrive in.

Segments of a recording wait in state until the watermark has passed their onset; then they are taken in order of onset. A turn is closed when no later segment can join it any more,
a conversation when no later turn can: both by an event-time timeout, so the last ones close as well once the watermark has moved on.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from annospark.operators.sessions import CONVERSATION_GAP_MS, TURN_GAP_MS

TURNS = "uid long, turn_idx long, label string, onset_ms long, offset_ms long, n_segments long"
#: A recording's time 0 as event time: Spark's watermark begins at 0 and takes what isn't later for late.
ORIGIN_MS = 86_400_000
CONVERSATIONS = "uid long, conv_idx long, onset_ms long, offset_ms long, n_turns long, is_multi_speaker boolean, labels string, n_transitions long"


STATE = "held string"


def _step(conversations: bool, turn_gap_ms: int, conversation_gap_ms: int, key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """One recording: takes the segments that began before the watermark, then closes what can't grow any more. Emits turns or conversations as they close.

    The state (segments that wait, the open turn and conversation, the next numbers) comes and goes with the rows, as one value: calls for each of its parts took most of the time.
    """
    waiting, turn, talk, turn_idx, conv_idx = json.loads(state.get[0]) if state.exists else ([], None, None, 0, 0)
    for pdf in batches if not state.hasTimedOut else ():
        pdf = pdf[pdf.label.notna()]  # rows without a label only move the watermark
        waiting += [[int(a), label, int(b)] for a, label, b in zip(pdf.onset_ms, pdf.label, pdf.offset_ms)]
    now = state.getCurrentWatermarkMs() - ORIGIN_MS
    waiting.sort()
    due = [r for r in waiting if r[0] < now]
    waiting = waiting[len(due) :]
    out: list[tuple] = []

    def close_talk() -> None:
        nonlocal talk
        if conversations:
            names = talk[4].split(";")
            out.append((*key, *talk[:4], len(names) > 1, talk[4], talk[5]))
        talk = None

    def close_turn() -> None:
        nonlocal turn, talk, conv_idx
        _, label, onset, offset, _ = turn
        if not conversations:
            out.append((*key, *turn))
        if talk and onset - talk[2] >= conversation_gap_ms:
            close_talk()
        if talk is None:
            talk, conv_idx = [conv_idx, onset, offset, 1, label, 0, label], conv_idx + 1
        else:
            talk = [talk[0], talk[1], offset, talk[3] + 1, ";".join(sorted({*talk[4].split(";"), label})), talk[5] + (label != talk[6]), label]
        turn = None

    for onset, label, offset in due:
        if turn and label == turn[1] and onset - turn[3] <= turn_gap_ms:
            turn[3], turn[4] = max(turn[3], offset), turn[4] + 1
            continue
        if turn:
            close_turn()
        turn, turn_idx = [turn_idx, label, onset, offset, 1], turn_idx + 1
    if turn and now - turn[3] > turn_gap_ms:
        close_turn()
    if talk and not turn and now - talk[2] >= conversation_gap_ms:
        close_talk()

    if waiting or turn_idx:
        state.update((json.dumps((waiting, turn, talk, turn_idx, conv_idx)),))
        # A timeout comes once the watermark is past its time.
        later = [waiting[0][0]] if waiting else []
        later += [turn[3] + turn_gap_ms] if turn else [talk[2] + conversation_gap_ms - 1] if talk else []
        if later:
            state.setTimeoutTimestamp(min(later) + ORIGIN_MS)
    if out:
        yield pd.DataFrame(out, columns=[c.split()[0] for c in (CONVERSATIONS if conversations else TURNS).split(", ")])


def _live(segments: DataFrame, delay: str, schema: str, *more) -> DataFrame:
    rows = segments.select("uid", "onset_ms", "offset_ms", "label", F.timestamp_millis(F.col("onset_ms") + ORIGIN_MS).alias("ts")).withWatermark("ts", delay)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        return _step(*more, key, batches, state)

    return rows.groupBy("uid").applyInPandasWithState(step, schema, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def live_turns(segments: DataFrame, delay: str = "1 minute", turn_gap_ms: int = TURN_GAP_MS) -> DataFrame:
    """Closed turns (uid, turn_idx, label, onset_ms, offset_ms, n_segments) of a stream of segments (uid, onset_ms, offset_ms, label), equal to `sessions.turns` of all segments.

    Onsets are event time, from 0 on; segments may arrive less than `delay` out of order, later ones are dropped. A turn is emitted once the watermark is more than
    `turn_gap_ms` past its end. Rows with a null label are no segments: they only say how far time has moved, for the last turns to close. State holds the segments
    of the last `delay` and one open turn for each recording.
    """
    return _live(segments, delay, TURNS, False, turn_gap_ms, CONVERSATION_GAP_MS)


def live_conversations(segments: DataFrame, delay: str = "1 minute", turn_gap_ms: int = TURN_GAP_MS, conversation_gap_ms: int = CONVERSATION_GAP_MS) -> DataFrame:
    """Closed conversations (uid, conv_idx, onset_ms, offset_ms, n_turns, is_multi_speaker, labels, n_transitions) of such a stream, equal to `sessions.conversations`:
    a conversation ends with its last turn, and is emitted once the watermark is `conversation_gap_ms` past that end. Rows and state are as in `live_turns`."""
    return _live(segments, delay, CONVERSATIONS, True, turn_gap_ms, conversation_gap_ms)
