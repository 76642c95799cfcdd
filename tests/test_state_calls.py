from unittest.mock import MagicMock

import pandas as pd

from tidemill.operators.steps import SlidingWindow
from tidemill.streaming import ordered as O
from tidemill.streaming import state as ST


def test_a_user_without_an_ended_session_sends_no_frame():
    p = ST.SessionProcessor(60_000)
    p.init(MagicMock())
    p.state.get.return_value = None
    rows = pd.DataFrame({"event_time": pd.to_datetime([0, 30], unit="s"), "amount": [1.0, None]})
    assert list(p.handleInputRows(("u",), iter([rows]), None)) == []
    p.state.update.assert_called_once_with((0, 30_000_000, 2, 1.0))
    assert not p.handle.listTimers.called and not p.handle.deleteTimer.called


def test_rows_that_wait_send_no_frame():
    p = O.InOrder(lambda: SlidingWindow(1000, 2), [], "allowed")
    p.init(MagicMock())
    p.handle.listTimers.return_value = []
    assert list(p.handleInputRows(("k",), iter([pd.DataFrame({"us": [5000], "id": [1]})]), None)) == []
