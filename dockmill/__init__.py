"""dockmill: document-collection analytics and corpus preparation on Spark."""
