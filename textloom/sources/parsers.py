"""What turns the bytes of a file into text: adapters around a parser of the caller's, and a limit of time for each file.

Parsers come in three shapes: those that give their results back, those that hand them to a callback as a document is ready, and
vision models that are told a backend. All give an :class:`Output`: the Markdown, the list of contents, and the middle form
from which both are made.
"""

from __future__ import annotations

import json
import multiprocessing
import traceback
from collections.abc import Callable
from typing import Any, NamedTuple

from pyspark import TaskContext

PIPELINE = "pipeline"
MARKDOWN, CONTENT_LIST = "mm_markdown", "content_list"


class Failed(Exception):
    """What a parser raised in its process: the message, and the traceback as text."""


class Output(NamedTuple):
    markdown: str
    content_list: str | None = None
    middle: str | None = None


def _output(middle: dict, make: Callable[[Any, str], Any]) -> Output:
    """``make(pages, kind)`` renders the pages of the middle form."""
    pages = middle["pdf_info"]
    return Output(make(pages, MARKDOWN), json.dumps(make(pages, CONTENT_LIST), ensure_ascii=False), json.dumps(middle, ensure_ascii=False))


def from_results(analyze: Callable, to_middle: Callable, make: Callable, lang: str = "ch", **options) -> Callable[[bytes], Output]:
    """A parser whose ``analyze(files, languages, **options)`` gives lists of results, images, documents, languages and OCR flags."""

    def parse(content: bytes) -> Output:
        results, images, documents, languages, ocr = analyze([content], [lang], **options)
        return _output(to_middle(results[0], images[0], documents[0], languages[0], ocr[0]), make)

    return parse


def from_callback(analyze: Callable, make: Callable, lang: str = "ch", **options) -> Callable[[bytes], Output]:
    """A parser that calls ``on_doc_ready(number, models, middle, ocr)`` when a document is ready."""

    def parse(content: bytes) -> Output:
        ready: list[dict] = []
        analyze([content], lang_list=[lang], on_doc_ready=lambda number, models, middle, ocr: ready.append(middle), **options)
        if not ready:
            raise ValueError("the parser told no document")
        return _output(ready[0], make)

    return parse


def from_model(analyze: Callable, make: Callable, backend: str, **options) -> Callable[[bytes], Output]:
    """A vision model, ``analyze(content, backend=name, **options)`` gives the middle form and the model's own output."""
    name = backend.removeprefix("vlm-")

    def parse(content: bytes) -> Output:
        return _output(analyze(content, backend=name, **options)[0], make)

    return parse


def choose(backend: str, pipeline: Callable[[bytes], Output], model: Callable[[str], Callable[[bytes], Output]]) -> Callable[[bytes], Output]:
    """The parser for a backend's name: ``pipeline``, or what ``model`` makes of any other name."""
    return pipeline if backend == PIPELINE else model(backend)


def device() -> str:
    """The accelerators of the running task, as kind:addresses; "cpu" where Spark gives it none."""
    task = TaskContext.get()
    given = {kind: ",".join(x.addresses) for kind, x in (task.resources() if task else {}).items()}
    return ";".join(f"{kind}:{given[kind]}" for kind in sorted(given)) or "cpu"


def _answer(parser: Callable, content: bytes, pipe) -> None:
    try:
        pipe.send((True, parser(content)))
    except BaseException as failed:
        pipe.send((False, (f"{type(failed).__name__}: {failed}", traceback.format_exc())))
    finally:
        pipe.close()


def within(seconds: float, parser: Callable[[bytes], Any]) -> Callable[[bytes], Any]:
    """``parser`` with a limit of time for each file. It runs in a process of its own, which is killed when the time is over, so neither
    a file that hangs nor one that brings the process down takes its task along."""

    def parse(content: bytes) -> Any:
        mine, theirs = multiprocessing.Pipe(False)
        child = multiprocessing.get_context("fork").Process(target=_answer, args=(parser, content, theirs), daemon=True)
        child.start()
        theirs.close()
        try:
            if not mine.poll(seconds):
                raise TimeoutError(f"timeout after {seconds:g} s")
            good, value = mine.recv()
        except EOFError:
            child.join()
            raise RuntimeError(f"the parser's process ended with code {child.exitcode}") from None
        finally:
            child.kill()
            child.join()
            mine.close()
        if not good:
            raise Failed(*value)
        return value

    return parse
