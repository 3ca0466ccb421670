"""Custom sink with a per-task lifecycle (open / process / close)."""

from __future__ import annotations

from collections.abc import Callable


class LifecycleWriter:
    """``writeStream.foreach`` writer: one connection per task and epoch,
    opened in ``open``, used for every row, released in ``close``."""

    def __init__(self, connect: Callable[[int, int], object], send: Callable[[object, object], None],
                 disconnect: Callable[[object], None]):
        self._connect, self._send, self._disconnect = connect, send, disconnect
        self._conn = None

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self._conn = self._connect(partition_id, epoch_id)
        return True

    def process(self, row) -> None:
        self._send(self._conn, row)

    def close(self, error) -> None:
        if self._conn is not None:
            self._disconnect(self._conn)
            self._conn = None
