"""Table writers: whole tables, appends, versions, validated splits, exports."""
