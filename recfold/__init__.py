"""recfold: fold flagged source records into one trusted row per event, on Spark."""
