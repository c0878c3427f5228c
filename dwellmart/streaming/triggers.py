"""When a stream runs."""

PERIOD = "30 seconds"


def trigger_for(mode: str = "once", period: str = PERIOD) -> dict:
    """``once`` takes in all that is there and stops; any other mode starts a micro-batch every period."""
    return {"availableNow": True} if mode == "once" else {"processingTime": period}
