"""Values the pipeline's results depend on.

Fixed values: they are part of the data contract, so changing one changes
results. Everything tunable is a function parameter instead.
"""

# Names that count as video, matched case-sensitively.
VIDEO_EXTENSIONS = (".mp4", ".avi", ".mov", ".m4v")

# Characters the strict scoring normaliser deletes.
STRICT_PUNCTUATION = r"""!()-[]{};.:'"\,<>./?@#$%^&*_~"""

# Audio and clip length contract.
SAMPLE_RATE = 16_000
MIN_CLIP_SECONDS = 0.0
MAX_CLIP_SECONDS = 30.0

# Batches, order and checkpoints.
BATCH_SIZE = 32
SHUFFLE_SEED = 22
IGNORED_LABEL = -100
KEPT_CHECKPOINTS = 10

# Every 100th scored row, from the 11th on, is reported.
PROGRESS_EVERY = 100
PROGRESS_OFFSET = 10

# Special label ids of our own vocabulary; words start at FIRST_WORD_ID.
PAD_ID, BOS_ID, EOS_ID, UNKNOWN_ID, FIRST_WORD_ID = 0, 1, 2, 3, 4

AUDIO_EXTENSION = ".wav"
