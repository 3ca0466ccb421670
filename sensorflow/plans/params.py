"""Query parameters used by the registered queries.

The reference's demo sizes (10 s windows, 5 s slides, 2-3 s delays) are
scaled to the test tables, where rows of one key are hours apart.  Every
operator takes these as arguments; these are only the registered choices.
"""

WINDOW_S = 3600          # tumbling / sliding window size
SLIDE_S = 1800           # sliding window slide
SESSION_GAP_S = 21600    # fixed session gap
DYN_GAP_PER_VC_S = 60    # per-record gap = vc minutes
COUNT_SIZE = 5           # count window size
COUNT_SLIDE = 2          # count window slide
DELAY_S = 600            # bounded out-of-orderness
LATENESS_S = 300         # allowed lateness
JOIN_LOWER_S = -1800     # interval join bounds (inclusive)
JOIN_UPPER_S = 1800
TTL_S = 43200            # value-state time-to-live
ALERT_VC = 10            # side-output / value-state alert threshold
FILTER_VC = 5            # where vc > 5
TS_CUT = 1705363200      # 2024-01-16 00:00:00 UTC, SQL filter boundary
N_PARTS = 4              # partitions for the distribution demos
TOPN = 2
TOPK_RUNNING = 3
TOPIC = "sensor"
TRIGGER_EVERY = 3        # global window: fire at every third record
TRIGGER_VC = 80          # global window: fire when vc > 80
EMIT_S = 7200            # period of the periodic watermark generator (arrival time)
IDLE_S = 14400           # an input without rows for so long does not hold the watermark back
FILE_PREFIX, FILE_SUFFIX = "sensor", ".log"
FILE_BYTES = 1500        # roll a row file at this size
FILE_EVERY_S = 21600     # and after so many seconds of its bucket
