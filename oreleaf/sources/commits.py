"""Numbered commits of a folder: which of its files are the table now.

Commit n of a folder is the file ``_commits/<n>.json`` in it. It is written under another
name first and renamed without replacing, so readers see whole commits only, and of several
writers of one number one wins and the others get :class:`Conflict`. This rests on the rename
of the file system being atomic and failing where the target exists, as HDFS' is; Structured
Streaming asks the same of its checkpoints.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors.exceptions.captured import CapturedException
from pyspark.sql import SparkSession
from py4j.protocol import Py4JJavaError

from oreleaf.sources.files import children, moved, read_text, write_text

_FOLDER, _SUFFIX = "_commits", ".json"


class Conflict(RuntimeError):
    """Another writer has made this commit."""


def latest(spark: SparkSession, path: str) -> tuple[int, dict]:
    """The newest commit's number and state; 0 and nothing where there is none."""
    known = [int(n[:-len(_SUFFIX)]) for n in children(spark, f"{path}/{_FOLDER}") if n.endswith(_SUFFIX) and n[:-len(_SUFFIX)].isdigit()]
    if not known:
        return 0, {}
    return max(known), json.loads(read_text(spark, _file(path, max(known))))


def commit(spark: SparkSession, path: str, number: int, state: dict) -> None:
    """Make ``state`` commit ``number`` of the folder, once for all writers."""
    _put(spark, path, _file(path, number), state)


def claim(spark: SparkSession, path: str, number: int, owner: str) -> None:
    """Reserve commit ``number`` for ``owner``; the same owner may claim it again, after it died for instance."""
    target = f"{path}/{_FOLDER}/{number:09d}.claim"
    try:
        _put(spark, path, target, {"owner": owner})
    except Conflict:
        holder = json.loads(read_text(spark, target))["owner"]
        if holder != owner:
            raise Conflict(f"commit {number} of {path} is claimed by {holder!r}") from None


def _file(path: str, number: int) -> str:
    return f"{path}/{_FOLDER}/{number:09d}{_SUFFIX}"


def _put(spark: SparkSession, path: str, target: str, state: dict) -> None:
    draft = f"{path}/{_FOLDER}/.{uuid.uuid4().hex}.tmp"
    write_text(spark, draft, json.dumps(state, sort_keys=True))
    try:
        moved(spark, draft, target)
    except (Py4JJavaError, CapturedException) as error:
        if "FileAlreadyExistsException" not in str(error):
            raise
        raise Conflict(f"{target} exists") from None
