"""A stack of rasters and command chains over all images of a table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from marram.functions import fixed
from marram.operators import raster as point
from marram.operators import stencil

COMMANDS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "grayscale": lambda frame: point.grayscale(frame, mode="shift"),
    "sepia": point.sepia,
    "half": point.half,
    "blur": stencil.gaussian_blur,
    "edges": stencil.sobel_edges,
    "colours": point.reduce_colours,
    "cartoon": stencil.cartoon,
}


class RasterStack:
    """Versions of a raster table, the original at the bottom.

    Entries are plans, not data: pushing, dropping and duplicating one costs
    nothing.
    """

    def __init__(self, original: DataFrame | None = None) -> None:
        self._entries: list[DataFrame] = [] if original is None else [original]

    def __len__(self) -> int:
        return len(self._entries)

    @property
    def current(self) -> DataFrame:
        return self.at(-1)

    def at(self, which: int) -> DataFrame:
        """An entry counted from the bottom, or from the top if negative."""
        if not -len(self) <= which < len(self):
            raise IndexError(f"no entry {which} in a stack of {len(self)}")
        return self._entries[which]

    def push(self, frame: DataFrame) -> RasterStack:
        self._entries.append(frame)
        return self

    def pop(self) -> DataFrame:
        if not self._entries:
            raise IndexError("the stack is empty")
        return self._entries.pop()

    def clone(self, which: int = -1) -> RasterStack:
        """Pushes an entry once more."""
        return self.push(self.at(which))

    def undo(self) -> RasterStack:
        """Drops the newest entry, but never the original."""
        if len(self) > 1:
            self.pop()
        return self

    def clear(self) -> RasterStack:
        self._entries.clear()
        return self

    def apply(self, operator: Callable[..., DataFrame], *args, **options) -> RasterStack:
        """Pushes the result of an operator on the current entry."""
        return self.push(operator(self.current, *args, **options))

    def merge_mask(self, mask: int, mask_colour: int = fixed.WHITE, other: int = -1) -> RasterStack:
        """Pushes entry ``mask`` with entry ``other`` showing where it has the colour."""
        return self.push(point.merge_mask(self.at(mask), self.at(other), mask_colour))


def run_commands(raster: DataFrame, commands: Sequence[str]) -> DataFrame:
    """The result of commands applied in order to all images.

    Commands are ``undo`` and the names in ``COMMANDS``.
    """
    unknown = [name for name in commands if name != "undo" and name not in COMMANDS]
    if unknown:
        raise ValueError(f"unknown commands: {', '.join(unknown)}")
    stack = RasterStack(raster)
    for name in commands:
        if name == "undo":
            stack.undo()
        else:
            stack.apply(COMMANDS[name])
    return stack.current
