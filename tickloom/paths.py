"""Files of the cluster's file systems, opened by tasks through Arrow."""

from __future__ import annotations

import re
import sys
from urllib.parse import quote

from pyspark.cloudpickle import register_pickle_by_value

# Travels inside plans, so executors need not have this package.
register_pickle_by_value(sys.modules[__name__])


def arrow_path(path: str):
    """The Arrow file system of a path in Hadoop's spelling, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", quote(path, safe="/:")).replace("s3a://", "s3://"))


def open_input(path: str):
    """A file, for reading at any place."""
    filesystem, inner = arrow_path(path)
    return filesystem.open_input_file(inner)
