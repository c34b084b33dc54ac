"""Which file a row came from: the file's name and what stands for its folder.

Both forms give the same texts: columns for rows, plain strings for the files a DataFrame lists.
"""

from hashlib import md5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hexadecimal digits that stand for a folder: its full URI would be too long for a folder name.
DIGITS = 16
MARK = "@"


def source(file_name: Column, uri: Column) -> Column:
    """Short text for a file: its name, and a hash of the folder part of the URI it was read from."""
    folder = F.regexp_replace(uri, "/[^/]*$", "")
    return F.concat(file_name, F.lit(MARK), F.substring(F.md5(folder), 1, DIGITS))


def file_name_of(uri: str) -> str:
    """The last part of a URI, in which special characters stay percent-encoded."""
    return uri.rsplit("/", 1)[1]


def source_of(uri: str) -> str:
    """``source`` of a file that is named after itself."""
    folder = uri.rsplit("/", 1)[0]
    return f"{file_name_of(uri)}{MARK}{md5(folder.encode()).hexdigest()[:DIGITS]}"


def file_name_in(source_text: str) -> str:
    """The file name that a source text was made of."""
    return source_text[: -DIGITS - len(MARK)]
