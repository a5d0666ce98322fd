class ManifestError(ValueError):
    """The manifest is empty or cannot be read."""


class AlignmentError(ValueError):
    """Two line-aligned lists differ in length."""


class ScratchDirError(RuntimeError):
    """A cluster session names no shared scratch folder."""
