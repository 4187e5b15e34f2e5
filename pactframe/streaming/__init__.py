"""Row rules on tables that are loaded continuously."""
