"""Small driver-side file operations on whatever file system a path names."""

import uuid

from py4j.protocol import Py4JJavaError


class FileTaken(RuntimeError):
    """The file to create is there already."""


def _fs(spark, path):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def exists(spark, path):
    fs, p = _fs(spark, path)
    return fs.exists(p)


def is_dir(spark, path):
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def names(spark, path):
    """Names of the direct children, empty for a missing folder."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def sizes(spark, path):
    """Bytes of the direct children by name."""
    fs, p = _fs(spark, path)
    return {s.getPath().getName(): s.getLen() for s in fs.listStatus(p)}


def make_dir(spark, path):
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def read_text(spark, path):
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark, path, text):
    """Write a new file; fails if it is there already.

    It is written under a name of its own and renamed without overwriting, so that the file
    is there with all its text or not at all.
    """
    fs, p = _fs(spark, path)
    partial = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
    stream = fs.create(partial, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    _give_name(spark, fs, partial, p)


def _give_name(spark, fs, partial, p):
    """Rename without overwriting."""
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark._jsparkSession.sessionState().newHadoopConf())
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        context.rename(fs.makeQualified(partial), fs.makeQualified(p), options)
    except Py4JJavaError as e:
        fs.delete(partial, False)
        if fs.exists(p):
            raise FileTaken(str(p)) from e
        raise


def remove(spark, path):
    """Remove a file; none is no error."""
    fs, p = _fs(spark, path)
    fs.delete(p, False)


def remove_tree(spark, path):
    """Remove a folder with what is in it; none is no error."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def rename(spark, source, target):
    """Give a file a name that is free, on the same file system."""
    fs, from_path = _fs(spark, source)
    _, to_path = _fs(spark, target)
    if not fs.rename(from_path, to_path):
        raise OSError(f"cannot rename {source} to {target}")


def move_tree(spark, source, target):
    """Give a folder the place of another one on the same file system, which goes."""
    fs, from_path = _fs(spark, source)
    _, to_path = _fs(spark, target)
    fs.delete(to_path, True)
    if not fs.rename(from_path, to_path):
        raise OSError(f"cannot move {source} to {target}")


def copy_tree(spark, source, target):
    """Copy a folder with what is in it, on one file system or between two."""
    from_fs, from_path = _fs(spark, source)
    to_fs, to_path = _fs(spark, target)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(from_fs, from_path, to_fs, to_path, False, conf)
