"""Small Hadoop FileSystem helpers (metadata operations only; no data passes the driver)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified form of a path (``/x`` -> ``file:/x`` on the local filesystem)."""
    fs, p = _path(spark, path)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return str(path(fs.makeQualified(p).toString()).toUri().toString())


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return bool(fs.exists(p))


def is_file(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return bool(fs.exists(p) and fs.getFileStatus(p).isFile())


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return bool(fs.exists(p) and fs.getFileStatus(p).isDirectory())


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.mkdirs(p)


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, p = _path(spark, src)
    jvm = spark.sparkContext._jvm
    return bool(fs.rename(p, jvm.org.apache.hadoop.fs.Path(dst)))


def move_file(spark: SparkSession, src: str, dst: str) -> None:
    """Rename a single file, replacing ``dst``; drops a checksum sidecar (``.name.crc``) that
    Hadoop's local filesystem keeps next to files (other filesystems have none)."""
    if exists(spark, dst):
        delete(spark, dst, recursive=False)
    if not rename(spark, src, dst):
        raise RuntimeError(f"could not move {src} to {dst}")
    parent, _, name = dst.rstrip("/").rpartition("/")
    sidecar = f"{parent}/.{name}.crc"
    if exists(spark, sidecar):
        delete(spark, sidecar, recursive=False)


def join_files(spark: SparkSession, parts: list[str], dst: str) -> None:
    """One file of the parts in their order, replacing ``dst``; the parts are consumed. HDFS links their
    blocks together; elsewhere the driver's JVM copies streams, a megabyte at a time, and a part goes as soon
    as it is copied, so that the disk holds one of them twice at most."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    parent, _, name = dst.rstrip("/").rpartition("/")
    joined = f"{parent or '.'}/.{name}.joining"
    fs, p = _path(spark, joined)
    fs.mkdirs(p.getParent())
    out = fs.create(p, True)
    out.close()
    if parts and fs.getScheme() == "hdfs":
        sources = spark.sparkContext._gateway.new_array(path, len(parts))
        for i, part in enumerate(parts):
            sources[i] = path(part)
        fs.concat(p, sources)
    else:
        out = fs.create(p, True)
        try:
            for part in parts:
                source = fs.open(path(part))
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
                finally:
                    source.close()
                fs.delete(path(part), False)
        finally:
            out.close()
    move_file(spark, joined, dst)
    sidecar = f"{parent or '.'}/..{name}.joining.crc"
    if exists(spark, sidecar):
        delete(spark, sidecar, recursive=False)


def rename_if_absent(spark: SparkSession, src: str, dst: str) -> bool:
    """Rename ``src`` to ``dst`` only if ``dst`` does not exist (``FileContext`` rename without
    OVERWRITE); False if it exists. ``FileSystem.rename`` would instead move a directory *into*
    an existing one."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src_p, dst_p = jvm.org.apache.hadoop.fs.Path(src), jvm.org.apache.hadoop.fs.Path(dst)
    fc = jvm.org.apache.hadoop.fs.FileContext.getFileContext(src_p.toUri(), conf)
    opts = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    opts[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        fc.rename(src_p, dst_p, opts)
        return True
    except Exception as exc:  # FileAlreadyExistsException from the JVM
        if "FileAlreadyExists" in str(exc) or exists(spark, dst):
            return False
        raise


def replace_file(spark: SparkSession, src: str, dst: str) -> None:
    """Rename ``src`` over ``dst`` atomically where the filesystem supports it (Hadoop
    ``FileContext`` rename with OVERWRITE); otherwise delete-then-rename."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src_p, dst_p = jvm.org.apache.hadoop.fs.Path(src), jvm.org.apache.hadoop.fs.Path(dst)
    try:
        fc = jvm.org.apache.hadoop.fs.FileContext.getFileContext(src_p.toUri(), conf)
        opts = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        opts[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        fc.rename(src_p, dst_p, opts)
    except Exception:  # filesystem without FileContext support: not atomic
        move_file(spark, src, dst)


def delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    fs, p = _path(spark, path)
    return bool(fs.delete(p, recursive))


def list_files(spark: SparkSession, path: str, suffix: str = "") -> list[str]:
    """Names of the plain files directly under ``path`` ending with ``suffix``."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for status in fs.listStatus(p):
        if status.isFile():
            name = status.getPath().getName()
            if name.endswith(suffix) and not name.startswith(("_", ".")):
                out.append(status.getPath().toString())
    return sorted(out)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(p) if s.isDirectory())


def write_text_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small control file (markers, properties), overwriting."""
    fs, p = _path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text_file(spark: SparkSession, path: str) -> str | None:
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        return str(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def lengths(spark: SparkSession, files: list[str]) -> list[int]:
    """Lengths of files named as :func:`input_files` does."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for name in files:
        p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name) if "%" in name else name)
        out.append(int(p.getFileSystem(conf).getFileStatus(p).getLen()))
    return out


def file_tails(spark: SparkSession, files: list[str], n: int, threads: int = 16) -> list[bytes]:
    """The last ``n`` bytes (all of a shorter file) of files named as :func:`input_files` does."""
    jvm = spark.sparkContext._jvm
    path, uri, read = jvm.org.apache.hadoop.fs.Path, jvm.java.net.URI, jvm.org.apache.commons.io.IOUtils.toByteArray
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    systems: dict[str, object] = {}  # by scheme and authority

    def tail(name: str) -> bytes:
        p = path(uri(name) if "%" in name else name)
        root = "/".join(name.split("/", 3)[:3]) if "://" in name else name.split("/", 1)[0]
        fs = systems.get(root)
        if fs is None:
            fs = systems.setdefault(root, p.getFileSystem(conf))
        size = fs.getFileStatus(p).getLen()
        stream = fs.open(p)
        try:
            if size > n:
                stream.seek(size - n)
            return bytes(read(stream))
        finally:
            stream.close()

    if not files:
        return []
    with ThreadPoolExecutor(min(threads, len(files))) as pool:
        return list(pool.map(tail, files))


def input_files(df) -> list[str]:
    """Paths of the files a file scan will read, as ``_metadata.file_path`` spells them. Spark lists
    them on the driver to plan the scan; nothing is read."""
    jvm = df.sparkSession.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path

    def spelt(name: str) -> str:
        if "%" in name:  # inputFiles escapes more than the metadata column does
            return path(path(jvm.java.net.URI(name)).toString()).toUri().toString()
        return name.replace(":///", ":/", 1)

    return [spelt(f) for f in df.inputFiles()]


def signature(spark: SparkSession, path: str) -> str:
    """Path, lengths and modification times of a file, or of all files below a folder."""
    fs, p = _path(spark, path)
    out = []
    files = fs.listFiles(p, True)
    while files.hasNext():
        f = files.next()
        out.append(f"{f.getPath().toUri()}:{f.getLen()}:{f.getModificationTime()}")
    return "|".join(sorted(out))
