from .runner import Counters, WindowRunner, run_with_restarts  # noqa: F401
from .stream import ProgressLog, start_off_hours_stream, start_window_stream  # noqa: F401
