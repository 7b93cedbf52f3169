"""SIS-shaped tables derived from the driver's TPC-H-like tables.

Each view is one SQL text that runs unchanged on Spark SQL and on DuckDB, so the
same derivation feeds both our Spark plans and the DuckDB oracle.  Work grows
with the driver tables: students come from ``customer``, enrolments from
``orders``/``lineitem``, behaviour from ``events`` and so on.  The only fixed
inputs are the tiny code lists (three term kinds, two address kinds), which are
part of the SIS data model, not of the data volume.

In Spark each view is analysed once per catalog (``spark.sql`` over the driver
tables) and kept as a DataFrame; in DuckDB the same texts are prepended as CTEs.

Fan-outs over fixed code lists (three term kinds, six cycle days, eight periods,
two contacts per student, three address kinds, three e-mails) are UNION ALLs,
never cross joins; school years are the (school, year) pairs found in the
orders, so even the calendar dimensions are derived from the data.
"""

from __future__ import annotations

from rollbook.functions.codes import HOMELESS_SERVICE_FLAGS

import re

# Driver tables (one parquet each).
DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# (name, sql) in creation order; later views may read earlier ones.
VIEWS: list[tuple[str, str]] = [
    ("schools", """
select n_nationkey+1 as id, n_nationkey+501 as dcid,
       case when n_nationkey=24 then 999999 else n_nationkey+1001 end as school_number,
       'School ' || n_name || ' ' || cast(n_regionkey as string) as name,
       case when n_nationkey % 3 = 0 then null else '701-555-' || lpad(cast(n_nationkey as string),4,'0') end as schoolphone,
       case when n_regionkey=4 then 1 else 0 end as issummerschool,
       case when n_nationkey % 4 = 0 then null else n_nationkey + 3001 end as alternate_school_number,
       'City ' || n_name as schoolcity, 'ND' as schoolstate, cast(58000 + n_nationkey as string) as schoolzip,
       case when n_nationkey % 2 = 0 then null else '701-555-9' || lpad(cast(n_nationkey as string),3,'0') end as schoolfax,
       'Principal ' || n_name as principal,
       case when n_nationkey % 5 = 0 then null else 'principal' || cast(n_nationkey as string) || '@district.example' end as principalemail
from nation"""),
    # (school, calendar year) pairs that occur in the data (customers' nation is the school), and the
    # planned year after each school's last
    ("school_years", """
select distinct c_nationkey + 1 as school_row, cast(extract(year from o_orderdate) as int) as y
from orders join customer on c_custkey = o_custkey
union
select c_nationkey + 1, max(cast(extract(year from o_orderdate) as int)) + 1
from orders join customer on c_custkey = o_custkey group by c_nationkey + 1"""),
    ("school_year_rows", "select s.*, sy.y from schools s join school_years sy on sy.school_row = s.id"),
    # three term kinds per school and year: the year record and two semesters
    ("terms", """
select (y+1-1990)*100 + k as id, y+1-1990 as yearid, school_number as schoolid,
       case when k=0 then 1 else 0 end as isyearrec,
       case when k=0 and issummerschool=1 then 'Summer ' || cast(y as string)
            when k=0 then cast(y as string) || '-' || cast(y+1 as string) when k=1 then 'S1' else 'S2' end as name,
       case k when 0 then 'YR' when 1 then 'S1' else 'S2' end as abbreviation,
       case when k=2 then make_date(y+1,1,10) when issummerschool=1 then make_date(y,7,6) else make_date(y,8,20) end as firstday,
       case when k=1 then make_date(y+1,1,9) else make_date(y+1,5,31) end as lastday
from (select school_number, issummerschool, y, 0 as k from school_year_rows union all
      select school_number, issummerschool, y, 1 from school_year_rows union all
      select school_number, issummerschool, y, 2 from school_year_rows) x"""),
    ("cust_span", """
select o_custkey, cast(min(o_orderdate) as date) as d0, cast(max(o_orderdate) as date) as d1, count(*) as n
from orders group by o_custkey"""),
    ("students", """
select c_custkey+1 as id, c_custkey+100001 as dcid, c_custkey as student_number, c_custkey+200001 as person_id,
       case when c_custkey % 97 = 0 then '  ' else ' ' || c_mktsegment || ' ' end as last_name,
       c_name as first_name,
       case c_custkey % 4 when 0 then 'M' when 1 then 'F' when 2 then 'X' end as gender,
       cast(c_custkey % 15 - 2 as int) as grade_level, c_nationkey+1001 as schoolid,
       d0 as entrydate, case when c_custkey % 5 = 0 then null else d1 end as exitdate,
       cast(case when c_custkey % 3 = 0 then -1 else 0 end as int) as enroll_status,
       case when c_custkey % 11 = 0 then 999999 when c_custkey % 7 = 0 then null else (c_nationkey+1) % 25 + 1001 end as next_school,
       case c_custkey % 4 when 0 then 'f' when 1 then 'R' when 2 then 'P' else null end as lunchstatus,
       case when c_custkey % 6 = 0 then null else 'E' || cast(c_custkey % 3 as string) end as entrycode,
       case when c_custkey % 5 = 0 then null else 'W' || cast(c_custkey % 4 as string) end as exitcode,
       cast(c_custkey % 15 - 1 as int) as sched_nextyeargrade,
       cast(c_acctbal as string) as state_studentnumber,
       case when c_custkey % 9 = 0 then null else cast(c_custkey * 7 % 1000000 as string) end as student_web_id,
       d0 as dob,
       case when c_custkey % 8 = 0 and c_custkey % 16 <> 0 then 'w' || cast(c_custkey as string) end as web_id,
       case when c_custkey % 3 = 0 then 'M' end as middle_name,
       case c_custkey % 4 when 0 then 'H' when 1 then 'N' else null end as ethnicity,
       case c_custkey % 3 when 0 then 'Y' when 1 then 'N' end as fedethnicity,
       cast(c_custkey as string) || ' Main St' as street, 'City ' || cast(c_nationkey as string) as city, 'ND' as state,
       cast(58000 + c_nationkey as string) as zip,
       case when c_custkey % 4 = 0 then null else 'PO Box ' || cast(c_custkey as string) end as mailing_street,
       case when c_custkey % 6 = 0 then null else 'Town ' || cast(c_nationkey as string) end as mailing_city,
       case when c_custkey % 4 = 0 then null else 'ND' end as mailing_state,
       case when c_custkey % 5 = 0 then null else cast(58100 + c_nationkey as string) end as mailing_zip,
       case when c_custkey % 5 = 0 then null else '701-' || lpad(cast(c_custkey % 10000 as string),4,'0') end as home_phone
from customer left join cust_span on o_custkey = c_custkey"""),
    ("reenrollments", """
select o_custkey+1 as studentid, cast(o_orderdate as date) as entrydate, cast(o_orderdate as date) + 120 as exitdate,
       cast(o_orderkey % 15 - 2 as int) as grade_level, cast(o_orderkey % 25 as int) + 1001 as schoolid,
       o_orderstatus as entrycode, case when o_orderstatus='O' then null else 'W1' end as exitcode
from orders where o_orderstatus <> 'P'"""),
    ("courses", """
select p_partkey+1 as id, 'C' || cast(p_partkey as string) as course_number, p_name || ' ' || p_type as course_name,
       case when p_size > 45 then 1 else 0 end as vocational,
       case when p_partkey % 4 = 0 then null else p_type end as sched_department
from part"""),
    ("sections", """
select s_suppkey*1000000 + p_partkey as id, s_suppkey + 1 as section_number, 'C' || cast(p_partkey as string) as course_number,
       s_nationkey + case p_partkey % 13 when 0 then 1 when 1 then 501 else 1001 end as schoolid,
       (cast(p_partkey % 7 as int)+1992+1-1990)*100 + cast(p_partkey % 3 as int) as termid,
       s_suppkey+1 as teacher, case when p_partkey % 6 = 0 then null else ' R' || cast(p_partkey % 40 as string) end as room,
       cast(p_size + 10 as int) as maxenrollment, case when p_partkey % 5 = 0 then 'Team ' || p_brand end as team
from (select distinct l_suppkey, l_partkey from lineitem) x join supplier on s_suppkey=l_suppkey join part on p_partkey=l_partkey"""),
    ("cc", """
select (case when l_returnflag='R' then -1 else 1 end) * (l_suppkey*1000000 + l_partkey) as sectionid,
       o_custkey+1 as studentid, 'C' || cast(l_partkey as string) as course_number,
       (cast(extract(year from l_shipdate) as int)+1-1990)*100 + l_linenumber % 3 as termid,
       cast(l_shipdate as date) as dateenrolled,
       case when l_linestatus='O' then null else cast(l_shipdate as date) + 90 end as dateleft
from lineitem join orders on o_orderkey=l_orderkey"""),
    ("attendance", """
select user_id+1 as studentid, cast(ts as date) as att_date, event_type as att_code from events"""),
    ("log", """
select event_id as id, user_id % 25 + 1001 as schoolid, cast(ts as date) as entry_date,
       case when event_type='view' then '  ' else event_type end as subject,
       cast(floor(value) as int) % 5 as logtypeid, props as entry,
       case when event_id % 4 = 0 then 'custom ' || cast(event_id as string) end as custom,
       case when event_id % 6 = 0 then null else lpad(cast(extract(hour from ts) as string),2,'0') || ':00' end as entry_time,
       case when event_type = 'error' then cast(ts as date) end as discipline_incidentdate,
       case when event_id % 3 = 0 then 'Room ' || cast(event_id % 9 as string) end as discipline_incidentlocation,
       case when event_id % 5 = 0 then 'Hall' end as discipline_incidentlocdetail
from events"""),
    ("psm_studentalert", """
select o_custkey+1 as studentid,
       o_orderpriority || ' ' || case o_orderkey % 12 when 0 then 'Hearing screen' when 1 then 'Vision/eye' when 2 then 'TB PPD'
                                   when 3 then 'Sport physical' when 4 then 'Dental' when 6 then 'Development check'
                                   when 7 then 'Preschool screen' when 8 then 'Social/emotional' when 9 then 'Speech, language'
                                   when 10 then 'Spine' else 'none' end as description,
       case when o_orderkey % 13 = 0 then null else cast(o_orderdate as date) end as dateexpires
from orders"""),
    ("fee", """
select p_partkey+1 as id, p_type as fee_type_name, p_brand as fee_type_id, 'C' || cast(p_partkey as string) as course_number,
       cast(p_partkey % 7 as int) + 6 as yearid
from part"""),
    ("fee_transaction", """
select l_partkey+1 as feeid, o_custkey+1 as studentid,
       cast(case when l_returnflag='R' then -l_extendedprice else l_extendedprice end as decimal(12,2)) as neteffect
from lineitem join orders on o_orderkey=l_orderkey"""),
    ("storedgrades", """
select o_custkey+1 as studentid, 'C' || cast(l_partkey as string) as course_number,
       case l_linenumber when 1 then 'Q1' when 2 then 'q2' when 3 then 'S1' when 4 then 'Y1' when 5 then 'FE' when 6 then ' P ' else 'X9' end as storecode,
       cast(round(l_quantity) as int) as percent, l_orderkey*10+l_linenumber as dcid, cast(l_shipdate as date) as datestored,
       cast(round(l_tax*100) as int) % 2 as excludefromgpa, cast(l_discount*10 as decimal(6,2)) as potentialcrhrs,
       (cast(extract(year from l_shipdate) as int)+1-1990)*100 + l_linenumber % 3 as termid,
       cast(l_orderkey % 25 as int) + 1001 as schoolid,
       case when l_orderkey % 17 = 0 then 'Course "' || cast(l_partkey as string) || '"' || chr(10) || 'part two'
            else 'Course ' || cast(l_partkey as string) end as course_name,
       case when l_linenumber = 7 then null else cast(l_linenumber + 5 as string) end as grade_level,
       case when l_returnflag = 'R' then null when l_quantity > 25 then 'A' else 'B' end as grade,
       case when l_linestatus = 'O' then null else cast(l_quantity / 10 as decimal(6,2)) end as earnedcrhrs,
       case when l_discount > 0.05 then cast(0.5 as decimal(4,2)) end as gpa_addedvalue,
       case when l_orderkey % 10 = 0 then 'Good "work"' || chr(13) || chr(10) || 'keep going'
            when l_orderkey % 10 = 1 then '   ' when l_orderkey % 10 = 2 then 'See  note ' || cast(l_orderkey % 7 as string) end as comment_value
from lineitem join orders on o_orderkey=l_orderkey"""),
]

# flag i is set on orders whose key is i mod 19; 16, 17 give no service, 18 leaves all flags NULL
_HOMELESS_FLAG_SQL = ", ".join(
    f"case when o_orderkey % 19 = {i} then 1 when o_orderkey % 19 = 18 then null else 0 end as {f}"
    for i, f in enumerate(HOMELESS_SERVICE_FLAGS))

VIEWS.extend([
    # ---- schedules: day calendar from order dates, cycle days / periods / bell
    # schedules per school and year (bounded by schools x years x a few codes)
    ("calendar_day", """
select distinct sch as schoolid, d as date_value,
       case when extract(day from d) % 7 = 0 then 0 else 1 end as insession,
       sch*10 + cast(extract(day from d) as int) % 6 as cycle_day_id,
       case when extract(day from d) % 11 = 0 then null else sch*10 + cast(extract(month from d) as int) % 2 end as bell_schedule_id
from (select cast(o_orderkey % 25 as int) + 1001 as sch, cast(o_orderdate as date) as d from orders) x"""),
    ("cycle_day", """
select school_number*10 + k as id, school_number as schoolid, y+1-1990 as year_id,
       case when k = 0 then null when k = 1 then '  ' when k = 2 then null else 'Day ' || cast(k+1 as string) end as day_name,
       case k when 0 then null when 1 then 'B' when 2 then ' ' when 3 then 'D' when 4 then 'E' else 'F' end as letter,
       case when k = 2 then 'C-ab' end as abbreviation, k + 1 as day_number
from (""" + " union all ".join(f"select school_number, y, {k} as k from school_year_rows" for k in range(6)) + """) x"""),
    ("period", """
select school_number*100 + n as id, school_number as schoolid, n as period_number,
       case when n % 3 = 0 then null else 'P' || cast(n as string) end as abbreviation,
       case when n % 4 = 0 then null else 'Period ' || cast(n as string) end as name
from (""" + " union all ".join(f"select school_number, {n} as n from schools" for n in range(1, 9)) + """) x"""),
    ("bell_schedule", """
select school_number*10 + m as id, school_number as schoolid, y+1-1990 as year_id
from (select school_number, y, 0 as m from school_year_rows union all
      select school_number, y, 1 from school_year_rows) x"""),
    ("bell_schedule_items", """
select distinct b.id as bell_schedule_id, p.id as period_id,
       28800 + p.period_number*3300 + (b.id % 10)*300 as start_time,
       28800 + p.period_number*3300 + (b.id % 10)*300 + 3000 as end_time
from bell_schedule b join period p on p.schoolid = b.schoolid"""),
    ("section_meeting", """
select id as sectionid, cast(id % 8 as int) + 1 as period_number,
       case id % 4 when 0 then 'B' when 1 then 'D' when 2 then 'E' else 'F' end as cycle_day_letter
from sections"""),
    ("schedulesections", """
select id, case when id % 5 = 0 or id % 3 <> 0 then null else 'S' || cast(id % 50 as string) end as room
from sections"""),
    # ---- staff from supplier
    ("users", """
select s_suppkey+1 as dcid, case when s_suppkey % 10 = 0 then null else 'T' || cast(s_suppkey as string) end as teachernumber,
       case s_suppkey % 19 when 4 then 'PowerSchool' when 5 then 'system' else s_name end as last_name, 'First' || cast(s_suppkey as string) as first_name,
       case when s_suppkey % 3 = 0 then 'M' end as middle_name,
       case when s_suppkey % 4 = 0 then null else 'staff' || cast(s_suppkey as string) || '@district.example' end as email_addr,
       cast(make_date(1990 + cast(s_suppkey % 9 as int), 1 + cast(s_suppkey % 12 as int), 1) as timestamp) as whencreated,
       case when s_suppkey % 7 = 0 then null else 'tl' || cast(s_suppkey as string) end as teacherloginid,
       case when s_suppkey % 13 = 0 then 'SYSTEM' when s_suppkey % 17 = 0 then null else 'u' || cast(s_suppkey as string) end as loginid,
       case s_suppkey % 5 when 0 then 0 when 1 then -1 when 2 then null when 3 then 36000 else 35000 end as allowloginstart,
       case s_suppkey % 6 when 0 then 0 when 1 then -1 when 2 then null when 3 then 36500 else 40000 end as allowloginend,
       cast(s_suppkey % 2 as int) as ptaccess
from supplier"""),
    ("schoolstaff", """
select s_suppkey+1 as users_dcid, s_nationkey+1001 as schoolid,
       case when s_suppkey % 9 = 0 then 2 when s_suppkey % 11 = 0 then null else 1 end as status,
       case when s_suppkey % 8 = 0 then 2 else 1 end as staffstatus
from supplier"""),
    # ---- people: student persons, two contacts per student, codes, phones, addresses, e-mails
    ("codeset", """
select 11 as codesetid, 'M' as code, 'Male' as displayvalue union all
select 12, 'F', 'Female' union all select 13, 'U', 'unknown' union all
select 40, 'MOT', 'Mother' union all select 41, 'FAT', 'Father' union all select 42, 'GRD', 'Guardian' union all
select 50, 'ND', 'ND' union all select 51, 'MN', 'MN'"""),
    ("contact_base", """
select c_custkey, c_nationkey, c_name, c_mktsegment, 1 as k from customer union all
select c_custkey, c_nationkey, c_name, c_mktsegment, 2 as k from customer"""),
    ("person", """
select c_custkey+200001 as id, trim(c_mktsegment) as lastname, c_name as firstname, cast(null as string) as middlename,
       cast(null as bigint) as suffixcodesetid, cast(null as bigint) as gendercodesetid
from customer
union all
select 300000 + c_custkey*10 + k, case when c_custkey % 23 = 0 then null else ' ' || trim(c_mktsegment) || ' ' end,
       'Parent' || cast(k as string), case when c_custkey % 3 = 0 then 'Q' end,
       case when c_custkey % 7 = 0 then 30 + k end,
       case when c_custkey % 11 = 0 then null when c_custkey % 10 = 0 then 13 when k = 1 then 12 else 11 end
from contact_base"""),
    ("studentcontactassoc", """
select c_custkey*10 + k as studentcontactassocid, c_custkey+100001 as studentdcid, 300000 + c_custkey*10 + k as personid,
       k as contactpriorityorder, case when c_custkey % 9 = 0 then null when k = 1 then 40 else 41 end as currreltypecodesetid
from contact_base"""),
    ("studentcontactdetail", """
select c_custkey*10 + k as studentcontactassocid,
       case when c_custkey % 8 = 0 then null when (c_custkey + k) % 5 = 0 then 0 else 1 end as isactive,
       case when c_custkey % 8 = 0 then null else k % 2 end as isemergency,
       case when c_custkey % 8 = 0 then null else 1 end as iscustodial,
       case when c_custkey % 8 = 0 then null when c_custkey % 4 = 0 then 0 else 1 end as receivesmailflg,
       case when c_custkey % 8 = 0 then null when k = 1 then 1 else 0 end as liveswithflg
from contact_base"""),
    ("personphonenumberassoc", """
select 300000 + c_custkey*10 + k as personid, 1 as phonenumberpriorityorder, 0 as ispreferred,
       case when c_custkey % 6 = 0 then null
            else ' 701-' || lpad(cast((c_custkey*3 + k) % 10000 as string),4,'0') || ' ' end as phonenumberasentered
from contact_base
union all
select 300000 + c_custkey*10 + k, 2, case when c_custkey % 6 = 0 then 1 else 0 end,
       case when c_custkey % 4 = 0 then null else '218-' || lpad(cast((c_custkey*7 + k) % 10000 as string),4,'0') end
from contact_base"""),
    ("personaddressassoc", """
select 300000 + c_custkey*10 + k as personid, (300000 + c_custkey*10 + k)*100 + 19 as personaddressid,
       19 as addresstypecodesetid, 1 as addresspriorityorder, cast(null as date) as enddate
from contact_base
union all
select 300000 + c_custkey*10 + k, (300000 + c_custkey*10 + k)*100 + 20, 20,
       case when c_custkey % 3 = 0 then 2 else 1 end, cast(null as date)
from contact_base
union all
select 300000 + c_custkey*10 + k, (300000 + c_custkey*10 + k)*100 + 18, 19, 1,
       case when c_custkey % 5 = 0 then make_date(1996, 1, 1) else make_date(1997, 6, 30) end
from contact_base"""),
    ("personaddress", """
select (300000 + c_custkey*10 + k)*100 + t as personaddressid,
       case t when 18 then 'Old Rd' else cast(c_custkey as string) || case t when 19 then ' Elm St' else ' PO' end end as street,
       case when t = 20 and c_custkey % 7 = 0 then null else 'City ' || cast(c_nationkey as string) end as city,
       cast(58000 + c_nationkey + t as string) as postalcode, case when c_custkey % 2 = 0 then 50 else 51 end as statescodesetid
from (select c_custkey, c_nationkey, k, 18 as t from contact_base union all
      select c_custkey, c_nationkey, k, 19 from contact_base union all
      select c_custkey, c_nationkey, k, 20 from contact_base) cb"""),
    ("emailaddress", """
select (c_custkey+200001)*10 + e as emailaddressid,
       case when c_custkey % 5 = 0 or (e = 3 and c_custkey % 2 <> 0) then null
            else lower(replace(c_name, '#', '')) || '.' || cast(e as string) || '@mail.example' end as emailaddress
from (select c_custkey, c_name, 1 as e from customer union all select c_custkey, c_name, 2 from customer
      union all select c_custkey, c_name, 3 from customer) ce"""),
    ("personemailaddressassoc", """
select c_custkey+200001 as personid, (c_custkey+200001)*10 + e as emailaddressid,
       case e when 1 then 2 when 2 then 1 else null end as emailaddresspriorityorder
from (select c_custkey, 1 as e from customer union all select c_custkey, 2 from customer
      union all select c_custkey, 3 from customer) ce"""),
    ("studentcorefields", """
select c_custkey+100001 as studentsdcid,
       case when c_custkey % 8 = 0 then 'CoreLast' || cast(c_custkey as string) end as pscore_legal_last_name,
       case when c_custkey % 12 = 0 then 'CoreFirst' end as pscore_legal_first_name,
       cast(null as string) as pscore_legal_middle_name,
       case when c_custkey % 16 = 0 then 'Jr' end as pscore_legal_suffix,
       case when c_custkey % 8 = 0 then 'F' end as pscore_legal_gender
from customer"""),
    ("studentrace", """
select c_custkey+1 as studentid, case c_custkey % 5 when 0 then 'B' when 1 then 'W' when 2 then 'A' when 3 then 'I' else 'X' end as racecd
from customer
union all
select c_custkey+1, case when c_custkey % 3 = 0 then 'P' end from customer"""),
    # ---- behaviour: log types, incidents from error events, their actions and roles
    ("gen", """
select 900 + n as id, case when n % 4 = 0 then 'other' else 'logtype' end as cat,
       case when n % 3 = 0 then null else 'Type' || cast(n as string) end as name,
       case when n % 2 = 0 then null when n = 1 then '  ' else 'Log ' || cast(n as string) end as value
from (select distinct logtypeid as n from log) x"""),
    ("incident", """
select event_id as incident_id, user_id % 25 + 1001 as school_number, ts as incident_ts,
       case when event_id % 4 = 0 then null else 'Gym ' || cast(event_id % 5 as string) end as location_details,
       case when event_id % 3 = 0 then '   ' else props || chr(10) || 'detail' end as incident_detail_desc,
       ts as created_ts, case when event_id % 2 = 0 then ts end as last_modified_ts
from events where event_type = 'error'"""),
    ("incident_action", """
select event_id as incident_id, event_id*10 + 1 as incident_action_id,
       case when event_id % 5 = 0 then null when event_id % 5 = 1 then '  ' else 'Action ' || cast(event_id % 4 as string) end as action_resolved_desc,
       case when event_id % 7 = 0 then null else cast(ts as date) end as action_plan_begin_dt,
       cast(ts as date) + 5 as action_plan_end_dt,
       case when event_id % 9 = 0 then make_date(2030, 1, 1) when event_id % 2 = 0 then cast(ts as date) + 3 end as action_actual_resolved_dt
from events where event_type = 'error'"""),
    ("incident_person_role", """
select case when event_id % 6 = 0 then null when event_id % 6 = 1 then ' ' else 'Role ' || cast(event_id % 5 as string) end as person_desc
from events where event_type in ('error', 'signup')"""),
    # ---- health concerns and special education
    ("healthconcerns", """
select o_custkey+100001 as studentsdcid,
       case o_orderkey % 5 when 0 then 'ASTH' when 1 then 'ALRG' when 2 then 'DIAB' when 3 then null else ' ' end as healthconcern,
       case when o_orderkey % 11 = 0 then null else o_orderpriority || ' concern' end as narrative,
       case when o_orderkey % 13 = 0 then null else cast(o_orderdate as date) end as startdate,
       case when o_orderkey % 3 = 0 then cast(o_orderdate as date) + 200 end as stopdate,
       case when o_orderkey % 4 = 0 then null else 'RN' || cast(o_orderkey % 7 as string) end as whocreated
from orders"""),
    ("cst_pubstuspeddata", """
select cast(c_acctbal as string) as state_studentnumber, cast(o_orderdate as date) as begindate,
       case when o_orderstatus = 'F' then cast(o_orderdate as date) + 300 end as enddate,
       case when o_orderkey % 4 = 0 then null else 'EX' || cast(o_orderkey % 6 as string) end as exceptionalityprimary,
       case when o_orderkey % 8 = 0 then null else 'ORD' end as primaryorderofdisability,
       case when o_orderkey % 16 = 0 then ' ' else 'ELIG' end as studenteligibility,
       case when o_orderkey % 3 = 0 then cast(o_orderdate as date) + 10 end as iepbegindate,
       cast(o_orderdate as date) + 30 as iepreviewdate,
       case when o_orderstatus = 'F' then 'Moved' end as reasonfortermination,
       cast(extract(year from o_orderdate) as int) + 1 as schoolyear
from orders join customer on c_custkey = o_custkey"""),
    # ---- standards and scores from parts and line items; comments from documents
    ("standard", """
select p_partkey+1 as standardid, case when p_partkey % 10 = 0 then null else p_partkey - p_partkey % 10 + 1 end as parentstandardid,
       p_partkey + 50000 as longitudinalid, cast(p_partkey % 7 as int) + 6 as yearid, p_name as name,
       p_type || ' "' || p_brand || '"' as description, 'STD.' || cast(p_partkey as string) as identifier,
       case when p_partkey % 3 = 0 then null else p_brand end as subjectarea, cast(p_size as int) as conversionscale,
       p_partkey + 7000 as gradescaleitemdcid, cast(p_partkey % 2 as int) as isassignmentallowed,
       case when p_partkey % 9 = 0 then 0 else 1 end as isactive,
       case when p_partkey % 9 = 0 then cast(make_date(1999, 6, 30) as timestamp) end as deactivatedate,
       cast(p_partkey % 100 as int) as displayposition, cast(p_partkey % 2 as int) as iscommentincluded,
       case when p_partkey % 2 = 0 then 200 end as maxcommentlength, 0 as isexcludedfromreports,
       case when p_partkey % 5 = 0 then 'batch-' || cast(p_partkey % 4 as string) end as importbatchtracking,
       'guid-' || cast(p_partkey as string) as psguid, 'admin' as whocreated,
       cast(make_date(1995, 1 + cast(p_partkey % 12 as int), 1) as timestamp) as whencreated,
       case when p_partkey % 4 = 0 then null else 'editor' end as whomodified,
       case when p_partkey % 4 = 0 then null else cast(make_date(1997, 1 + cast(p_partkey % 12 as int), 15) as timestamp) end as whenmodified,
       case when p_partkey % 6 = 0 then 'C' || cast(p_partkey as string) end as transientcourselist,
       case when p_partkey % 8 = 0 then null else 'EXT' || cast(p_partkey as string) end as externalid,
       coalesce(case when p_partkey % 10 = 0 then null else p_partkey - p_partkey % 10 + 1 end, 0) as parentstandardid_nvl
from part"""),
    ("assignmentstandardassoc", """
select p_partkey + 1 as assignmentstandardassocid, case when p_partkey % 50 = 0 then null else p_partkey + 1 end as standardid
from part"""),
    ("standardscore", """
select l_partkey + 1 as assignmentstandardassocid, o_custkey + 100001 as studentsdcid,
       cast(extract(year from l_shipdate) as int) + 1 - 1990 as yearid,
       case when l_linenumber = 1 then 'P' end as actualscoreentered,
       case when l_linenumber <= 2 then 'B' end as scorelettergrade,
       case when l_linenumber = 3 then cast(l_discount as decimal(6,2)) when l_linenumber <= 4 then cast(l_quantity as decimal(6,2)) end as scorenumericgrade,
       case when l_linenumber <= 5 then cast(l_discount * 100 as decimal(6,2)) end as scorepercent,
       cast(l_linenumber % 2 as int) as isexempt, 0 as ismissing, 0 as islate
from lineitem join orders on o_orderkey = l_orderkey"""),
    # comments: whole documents (section comments) and conversation turns (rollup comments)
    ("standardgradesectioncomment", "select text as commentvalue from documents"),
    ("standardgraderollupcomment", "select text as commentvalue from conversations"),
    ("s_nd_stu_x", """
select c_custkey+100001 as studentsdcid,
       case when c_custkey % 10 = 0 then upper(c_name) end as legalfirstname,
       case when c_custkey % 10 = 0 then 'Q' end as legalmiddlename,
       case when c_custkey % 10 = 0 then 'LEGAL' || cast(c_nationkey as string) end as legallastname,
       case c_custkey % 10 when 0 then 'F' when 5 then 'M' end as legalgender,
       case when c_custkey % 4 = 1 then 'UNIT ' || cast(c_nationkey as string) end as servingspecialedunit,
       case when c_custkey % 3 = 0 then 'Y' else 'N' end as sendtotienet,
       case when c_custkey % 6 = 1 then 1 else 0 end as section504,
       cast(d0 as timestamp) as whencreated
from customer left join cust_span on o_custkey = c_custkey"""),
    ("s_nd_stu_homelessprograms_c", """
select o_custkey+100001 as studentsdcid,
       case when o_orderkey % 10 = 3 then null else cast(o_orderdate as date) end as startdate, """
     + _HOMELESS_FLAG_SQL + """
from orders"""),
])

VIEW_SQL: dict[str, str] = {name: " ".join(sql.split()) for name, sql in VIEWS}

# per-school dimensions: bounded by schools x calendar years x a few codes
DIMENSION_VIEWS = frozenset({
    "schools", "school_years", "school_year_rows", "terms", "cycle_day", "period", "bell_schedule",
    "bell_schedule_items", "codeset", "gen",
})
_ORDER = {name: i for i, (name, _) in enumerate(VIEWS)}


def _refs(sql: str) -> set[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", sql))
    return {w for w in words if w in VIEW_SQL}


def closure(names) -> list[str]:
    """All views needed (transitively) by ``names``, in creation order."""
    need: set[str] = set()
    stack = [n for n in names if n in VIEW_SQL]
    while stack:
        n = stack.pop()
        if n in need:
            continue
        need.add(n)
        stack.extend(r for r in _refs(VIEW_SQL[n]) if r != n)
    return sorted(need, key=_ORDER.__getitem__)


def with_views(sql: str, provided=()) -> str:
    """Prefix ``sql`` with the CTEs of every derived view it reads (DuckDB oracle).
    Views named in ``provided`` are expected to exist already (not re-derived)."""
    used = [v for v in closure(_refs(sql)) if v not in provided]
    if not used:
        return sql
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n]})" for n in used)
    body = sql.strip()
    if body[:4].lower() == "with":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
