"""Jobs: operators put together into the batch, the audit and their outputs."""
