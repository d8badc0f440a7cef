"""The three jobs, from source tables to written tables.

Each job writes the table its later steps share and reads it back. That cuts
the lineage at a file on the shared output folder, so a lost executor never
brings the large joins or the classifier calls back.
"""
