"""Writers; they run the job."""
