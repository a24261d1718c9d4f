"""Batch transformers that ask a remote function, in requests of bounded size."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from tidemark.functions.registry import BatchTransformer
from tidemark.plans.resilience import CircuitBreaker, Open


@dataclass
class Answer:
    """What the remote function says of one record; data None keeps the record's own data."""

    success: bool = True
    keep: bool = True
    retryable: bool = False
    data: dict | None = None


#: Stands in the text of errors that a worker raises, by which the driver knows them again.
MARK = "tidemark-retryable"


class Retryable(RuntimeError):
    """A failure that says nothing about the batch: it has to be tried again and is never counted against it."""

    def __str__(self) -> str:
        return f"[{MARK}] {super().__str__()}"


class RemoteError(Retryable):
    """The remote function asks for another try, or its answers can't be matched to the records."""


class TransportError(Retryable):
    """A failure of the way to a remote function or a sink."""


def retryable(error: BaseException) -> bool:
    """Whether an error, or what a worker's error has become on the driver, is one of these."""
    seen: set[int] = set()
    while error is not None and id(error) not in seen:
        if isinstance(error, Retryable) or f"[{MARK}]" in str(error):
            return True
        seen.add(id(error))
        error = error.__cause__ or error.__context__
    return False


def requests(sizes: list[int], budget: int) -> list[tuple[int, int]]:
    """Stretches of records whose sizes fit the budget; one that doesn't goes alone."""
    out, start, used = [], 0, 0
    for i, s in enumerate(sizes):
        if i > start and used + s > budget:
            out.append((start, i))
            start, used = i, 0
        used += s
    return [*out, (start, len(sizes))] if sizes else out


def remote(ask: Callable[[list[dict]], list[Answer]], budget: int = int(0.95 * (1 << 20)), close: Callable[[], None] | None = None, breaker: Callable[[], CircuitBreaker] | None = CircuitBreaker) -> BatchTransformer:
    """Fails closed: an error of the call, a wrong number of answers or a retryable failure fails the batch.

    A failure that isn't retryable drops its record, except a schema change, which always has to be tried again. Each worker
    has a breaker of its own; while it is open, calls fail at once as failures of the way.
    """

    def run(frames):
        guard = breaker() if breaker else None

        def call(rows):
            try:
                return guard.call(lambda: ask(rows)) if guard else ask(rows)
            except (OSError, Open) as error:
                raise TransportError(f"{type(error).__name__}: {error}") from error

        for d in frames:
            rows = d.to_dict("records")
            sizes = [sum(len(str(k)) + len(str(v)) for k, v in dict(r.get("data") or {}).items()) + 64 for r in rows]
            keep, data = [], []
            for a, b in requests(sizes, budget):
                answers = call(rows[a:b])
                if len(answers) != b - a:
                    raise RemoteError(f"{len(answers)} answers to {b - a} records")
                for row, answer in zip(rows[a:b], answers, strict=True):
                    if not answer.success and (answer.retryable or row.get("op") == "schema_change"):
                        raise RemoteError("the remote function asks to try again")
                    keep.append(answer.success and answer.keep)
                    data.append(row.get("data") if answer.data is None else answer.data)
            if "data" in d.columns:
                d = d.assign(data=data)
            yield d[keep] if len(d) else d

    return BatchTransformer(run, close)
