"""Versions of a folder: one small file names what belongs to the current one.

Files are numbered and never change, so a reader sees a version whole or not at all, and there is
no moment without one. A version is published by creating the file of the next number, which fails
where another writer was first. What the version before names stays on disk until the next one is
published, so a reader that has just looked is not overtaken.
"""

import json
import time

from pagetide.session import delete_folder, file_system

_FOLDER = "snapshots"
# How long a reader may take where versions follow each other quickly.
KEEP_SECONDS = 600


def _path(spark, folder, name=""):
    return file_system(spark, f"{folder.rstrip('/')}/{_FOLDER}/{name}".rstrip("/"))


def numbers(spark, folder):
    """Numbers of the versions that are there, newest first."""
    path, files = _path(spark, folder)
    if not files.exists(path):
        return []
    names = [status.getPath().getName() for status in files.listStatus(path)]
    return sorted((int(name) for name in names if name.isdigit()), reverse=True)


def _content(spark, folder, number):
    """What a version names; None while its file is being written, or when it is gone."""
    path, files = _path(spark, folder, str(number))
    try:
        stream = files.open(path)
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
    except Exception as error:  # py4j has no class of its own for a Java exception
        if "FileNotFound" in str(error):
            return None
        raise
    return json.loads(text) if text.endswith("\n") else None


def current(spark, folder):
    """Number and content of the newest complete version; 0 and None where there is none."""
    while found := numbers(spark, folder):
        for number in found:
            content = _content(spark, folder, number)
            if content is not None:
                return number, content
        if found == numbers(spark, folder):
            # The first one of all is being written.
            break
    return 0, None


def retired(spark, folder, content, gone, keep=KEEP_SECONDS):
    """The folders that versions have stopped naming, with the time, `gone` among them now.

    Those that went longer than `keep` seconds ago are removed and forgotten: no reader that began
    with them should still be at work.
    """
    now = time.time()
    left = {**(content or {}).get("retired", {}), **{path: now for path in gone}}
    for path in [path for path, since in left.items() if since < now - keep]:
        delete_folder(spark, f"{folder}/{path}")
        del left[path]
    return left


def publish(spark, folder, number, content):
    """Make `content` the version `number`. Versions before the last one are forgotten.

    What a writer that was lost has left unfinished is removed first.
    """
    path, files = _path(spark, folder, str(number))
    if files.exists(path) and _content(spark, folder, number) is None:
        files.delete(path, False)
    stream = files.create(path, False)
    stream.write(bytearray(f"{json.dumps(content)}\n".encode()))
    stream.close()
    for old in numbers(spark, folder):
        if old < number - 1:
            files.delete(_path(spark, folder, str(old))[0], False)
