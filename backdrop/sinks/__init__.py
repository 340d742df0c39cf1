"""Writers: processed frames by session, PNG export, result and reply tables."""
