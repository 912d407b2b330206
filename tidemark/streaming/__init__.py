from .state import NewestRow, newest_rows, use_state_store
from .upsert import StreamedTable, batch_progress
