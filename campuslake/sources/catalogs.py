"""The catalogs: grade scales, costs, schools, backgrounds, visas and timelines.

Each is a small constant table; the builders return DataFrames with explicit
schemas, and values() writes the same rows as SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# ---- Fixed values: grade bands; a score of at least the bound earns the points (times ten) ----
SCALES = {
    "standard40": (40, [(90, 40), (80, 30), (70, 20), (60, 10)]),
    "pku40": (40, [(90, 40), (85, 37), (82, 33), (78, 30), (75, 27), (72, 23), (68, 20), (64, 15), (60, 10)]),
    "improved40v1": (40, [(85, 40), (70, 30), (60, 20)]),
    "improved40v2": (40, [(85, 40), (75, 30), (60, 20)]),
    "canada43": (43, [(90, 43), (85, 40), (80, 37), (77, 33), (73, 30), (70, 27), (67, 23), (63, 20), (60, 17)]),
    "ustc43": (43, [(95, 43), (90, 40), (85, 37), (82, 33), (78, 30), (75, 27), (72, 23), (68, 20), (65, 17), (64, 15), (61, 13), (60, 10)]),
    "wes40": (40, [(85, 40), (75, 30), (60, 20)]),
}

SCALE_NAMES = {
    "standard40": "标准 4.0", "pku40": "北大 4.0", "improved40v1": "改进 4.0 (版1)", "improved40v2": "改进 4.0 (版2)",
    "canada43": "加拿大 4.3", "ustc43": "中科大 4.3", "wes40": "WES 4.0",
}

# ---- Fixed values: costs. country, name, flag, currency, rate to CNY, application fee, hidden fee (CNY) ----
COUNTRIES = [
    ("us", "美国", "🇺🇸", "USD", 7.2, 2000, 15000),
    ("uk", "英国", "🇬🇧", "GBP", 9.1, 1500, 12000),
    ("hk", "中国香港", "🇭🇰", "HKD", 0.92, 800, 5000),
    ("sg", "新加坡", "🇸🇬", "SGD", 5.3, 1000, 6000),
]
# country, place among its cities, city, name, living multiplier, accommodation base (local currency)
CITIES = [
    ("us", 0, "us-nyc", "纽约/加州 (一线)", 1.3, 1800.0),
    ("us", 1, "us-chicago", "芝加哥/波士顿 (二线)", 1.1, 1200.0),
    ("us", 2, "us-other", "其他地区 (三线)", 0.9, 800.0),
    ("uk", 0, "uk-london", "伦敦", 1.4, 1200.0),
    ("uk", 1, "uk-other", "非伦敦地区", 1.0, 700.0),
    ("hk", 0, "hk-all", "全区", 1.2, 8000.0),
    ("sg", 0, "sg-all", "全区", 1.2, 1500.0),
]
# country, degree, public and private tuition a year (local currency), default duration in years
DEGREES = [
    ("us", "bachelor", 35000.0, 55000.0, 4.0), ("us", "master_taught", 40000.0, 60000.0, 1.5), ("us", "master_research", 30000.0, 50000.0, 2.0), ("us", "phd", 30000.0, 50000.0, 5.0),
    ("uk", "bachelor", 20000.0, 20000.0, 3.0), ("uk", "master_taught", 25000.0, 25000.0, 1.0), ("uk", "master_research", 22000.0, 22000.0, 2.0), ("uk", "phd", 20000.0, 20000.0, 3.5),
    ("hk", "bachelor", 145000.0, 160000.0, 4.0), ("hk", "master_taught", 200000.0, 250000.0, 1.0), ("hk", "master_research", 42100.0, 42100.0, 2.0), ("hk", "phd", 42100.0, 42100.0, 3.0),
    ("sg", "bachelor", 30000.0, 35000.0, 3.5), ("sg", "master_taught", 40000.0, 45000.0, 1.0), ("sg", "master_research", 35000.0, 35000.0, 2.0), ("sg", "phd", 35000.0, 35000.0, 4.0),
]
# what the form offers: id, name (and the multiplier of an accommodation)
DEGREE_TYPES = [("bachelor", "本科"), ("master_taught", "硕士 (授课型)"), ("master_research", "硕士 (研究型)"), ("phd", "博士")]
SCHOOL_TYPES = [("public", "公立"), ("private", "私立"), ("unsure", "不确定")]
ACCOMMODATIONS = [("dorm", "学校宿舍", 1.0), ("share", "校外合租", 0.8), ("solo", "校外独住", 1.5)]

# ---- Fixed values: schools. id, name, English name, country, ranking, required GPA, TOEFL, IELTS, tags ----
SCHOOLS = [
    ("us-1", "普林斯顿大学", "Princeton University", "US", 1, 3.9, 110, None, ["常春藤", "学术顶尖"]),
    ("us-2", "麻省理工学院", "MIT", "US", 2, 3.9, 110, None, ["理工科强校", "科研"]),
    ("us-3", "哈佛大学", "Harvard University", "US", 3, 3.9, 110, None, ["常春藤", "综合顶尖"]),
    ("us-4", "斯坦福大学", "Stanford University", "US", 3, 3.9, 110, None, ["硅谷核心", "创业氛围"]),
    ("us-10", "西北大学", "Northwestern University", "US", 10, 3.8, 105, None, ["新闻传媒", "商科"]),
    ("us-15", "康奈尔大学", "Cornell University", "US", 15, 3.8, 105, None, ["常春藤", "工科"]),
    ("us-20", "加州大学伯克利分校", "UC Berkeley", "US", 20, 3.8, 100, None, ["公立常春藤", "理工科"]),
    ("us-28", "南加州大学", "USC", "US", 28, 3.7, 100, None, ["传媒强", "洛杉矶"]),
    ("us-35", "纽约大学", "NYU", "US", 35, 3.6, 100, None, ["曼哈顿", "商科艺术"]),
    ("us-40", "波士顿大学", "Boston University", "US", 40, 3.5, 90, None, ["波士顿", "综合"]),
    ("us-50", "俄亥俄州立大学", "Ohio State University", "US", 50, 3.3, 80, None, ["公立大校", "体育强"]),
    ("uk-1", "牛津大学", "University of Oxford", "UK", 1, 3.8, None, 7.5, ["G5", "书院制"]),
    ("uk-2", "剑桥大学", "University of Cambridge", "UK", 2, 3.8, None, 7.5, ["G5", "书院制"]),
    ("uk-3", "帝国理工学院", "Imperial College London", "UK", 3, 3.7, None, 7.0, ["G5", "理工科强校"]),
    ("uk-4", "伦敦大学学院", "UCL", "UK", 4, 3.6, None, 7.0, ["G5", "综合强校"]),
    ("uk-5", "伦敦政治经济学院", "LSE", "UK", 5, 3.7, None, 7.0, ["G5", "社科商科强校"]),
    ("uk-8", "爱丁堡大学", "University of Edinburgh", "UK", 8, 3.5, None, 6.5, ["罗素集团", "苏格兰"]),
    ("uk-10", "曼彻斯特大学", "University of Manchester", "UK", 10, 3.4, None, 6.5, ["红砖大学", "商科强"]),
    ("uk-15", "布里斯托大学", "University of Bristol", "UK", 15, 3.3, None, 6.5, ["红砖大学", "工科强"]),
    ("uk-20", "格拉斯哥大学", "University of Glasgow", "UK", 20, 3.2, None, 6.5, ["罗素集团", "历史悠久"]),
    ("hk-1", "香港大学", "HKU", "HK", 1, 3.6, None, 6.5, ["港三所", "综合顶尖"]),
    ("hk-2", "香港中文大学", "CUHK", "HK", 2, 3.5, None, 6.5, ["港三所", "文社科强"]),
    ("hk-3", "香港科技大学", "HKUST", "HK", 3, 3.5, None, 6.5, ["港三所", "商科理工强"]),
    ("hk-4", "香港城市大学", "CityU", "HK", 4, 3.3, None, 6.5, ["港五所", "发展迅速"]),
    ("hk-5", "香港理工大学", "PolyU", "HK", 5, 3.3, None, 6.5, ["港五所", "实用型"]),
    ("hk-6", "香港浸会大学", "HKBU", "HK", 6, 3.0, None, 6.0, ["传媒强", "博雅教育"]),
]

# ---- Fixed values: what an applicant's background adds to the GPA; any other code adds nothing ----
BACKGROUNDS = [
    ("overseas_hs", 0.1), ("top_international", 0.1), ("top_public", 0.05), ("normal_international", 0.0), ("key_public", 0.0), ("normal_public", -0.1),
    ("c9", 0.15), ("overseas", 0.15), ("985", 0.1), ("211", 0.05), ("coop", 0.05), ("double_first", 0.0), ("normal", 0.0), ("other", -0.1),
    ("top_overseas", 0.15), ("c9_985", 0.15), ("research_inst", 0.15), ("normal_overseas", 0.05), ("211_double_first", 0.05), ("normal_cn", -0.15),
]

# ---- Fixed values: visas. country, its name, visa, type, name, description, processing time, visa fee (amount, currency, CNY), SEVIS fee, health fee ----
VISAS = [
    ("us", "美国", "us-f1", "F1", "F-1 学生签证", "全日制学术课程（本科/硕士/博士/语言课程）", "面签当天出结果，护照返回 3-7 个工作日", (185, "USD", 1340), (350, "USD", 2540), None),
    ("us", "美国", "us-j1", "J1", "J-1 访问学者签证", "交流访问学者、交换生等", "面签当天出结果，护照返回 3-7 个工作日", (185, "USD", 1340), (220, "USD", 1595), None),
    ("uk", "英国", "uk-student", "Student", "Student Visa (原Tier 4)", "16岁以上赴英攻读学位或长期课程", "标准服务 3 周内（可加急）", (490, "GBP", 4500), None, (776, "GBP", 7100)),
    ("au", "澳大利亚", "au-500", "Subclass 500", "学生签证 (500类别)", "赴澳攻读各类全日制课程", "通常 2-4 周（大学高等教育类）", (710, "AUD", 3400), None, None),
]
SECTIONS = ["core", "financial", "academic", "supporting"]
# visa, section, item, name, required, preparation time, notes, needs translation
VISA_ITEMS = [
    ("us-f1", "core", "us-f1-core-1", "有效护照", True, "首次 7-15 工作日", "有效期超出留学期间至少 6 个月，至少 2 页空白签证页", False),
    ("us-f1", "core", "us-f1-core-2", "DS-160 确认页", True, "1-2 小时", "在线填写后打印确认页，记住申请编号", False),
    ("us-f1", "core", "us-f1-core-3", "I-20 表格", True, "学校签发 1-4 周", "由录取学校签发，须本人签字；转学需新 I-20", False),
    ("us-f1", "core", "us-f1-core-4", "面签预约单", True, "预约后立等可取", "缴费后预约面签时间的确认凭证", False),
    ("us-f1", "core", "us-f1-core-5", "SEVIS 缴费收据 (I-901)", True, "缴费后立等可取", "在线缴纳SEVIS费后打印的凭证", False),
    ("us-f1", "core", "us-f1-core-6", "签证照片 (51mm x 51mm)", True, "1-2 天", "近6个月内白底彩照，露出双耳，不可戴眼镜", False),
    ("us-f1", "financial", "us-f1-fin-1", "银行存款证明", True, "1-3 工作日", "金额 ≥ I-20 上标注的第一年费用；冻结至少到签证面试后", True),
    ("us-f1", "financial", "us-f1-fin-2", "父母收入证明", False, "3-5 工作日", "如资金由父母提供，需提供父母在职及收入证明", True),
    ("us-f1", "financial", "us-f1-fin-3", "房产/车产证明", False, "1-3 工作日", "非必需，作为辅助财力证明增加过签率", True),
    ("us-f1", "academic", "us-f1-acad-1", "学校录取通知书 (Offer/Admission Letter)", True, "已获得", "原件或高清晰打印件", False),
    ("us-f1", "academic", "us-f1-acad-2", "官方成绩单", True, "1-2 周", "中英文对照，加盖学校公章并密封", True),
    ("us-f1", "academic", "us-f1-acad-3", "学位证/毕业证/在读证明", True, "1-2 周", "中英文对照原件，加盖学校公章", True),
    ("us-f1", "academic", "us-f1-acad-4", "语言成绩单 (TOEFL/IELTS等)", False, "已获得", "提供复印件即可，证明语言能力符合要求", False),
    ("us-f1", "academic", "us-f1-acad-5", "学习计划 (Study Plan)", False, "3-5 天", "特别是敏感专业/硕博申请者，强烈建议准备", True),
    ("us-f1", "academic", "us-f1-acad-6", "导师简历/个人简历", False, "1-3 天", "硕博申请者必需，包含研究方向说明", True),
    ("us-f1", "supporting", "us-f1-sup-1", "户口本原件", False, "已获得", "证明亲属关系（如资助人为父母）", True),
    ("us-f1", "supporting", "us-f1-sup-2", "旧护照", False, "已获得", "如有旧护照必须提供，以展示过往出入境记录", False),
    ("us-j1", "core", "us-j1-core-1", "有效护照", True, "首次 7-15 工作日", "有效期超出计划停留期至少 6 个月", False),
    ("us-j1", "core", "us-j1-core-2", "DS-2019 表格", True, "机构签发 2-4 周", "由美国赞助机构签发，须本人签字", False),
    ("us-j1", "core", "us-j1-core-3", "DS-160 确认页", True, "1-2 小时", "在线填写后打印确认页", False),
    ("us-j1", "core", "us-j1-core-4", "SEVIS 缴费收据 (I-901)", True, "缴费后立等可取", "某些政府资助项目可能免除", False),
    ("us-j1", "financial", "us-j1-fin-1", "资金证明", True, "1-3 工作日", "需覆盖在美期间生活费用，如由赞助方提供需出具证明", True),
    ("us-j1", "academic", "us-j1-acad-1", "邀请信", True, "已获得", "美国接收机构或导师出具的正式邀请函", False),
    ("us-j1", "academic", "us-j1-acad-2", "个人简历", True, "1-3 天", "详细的教育和工作经历，英文", True),
    ("uk-student", "core", "uk-stu-core-1", "有效护照", True, "首次 7-15 工作日", "至少留有一页正反两面都是空白的签证页", False),
    ("uk-student", "core", "uk-stu-core-2", "CAS (Confirmation of Acceptance for Studies)", True, "学校发放 1-2 周", "学校提供的一个电子参考号码，无需纸质文件", False),
    ("uk-student", "core", "uk-stu-core-3", "签证申请表打印件", True, "1-2 小时", "在线提交后打印，签字", False),
    ("uk-student", "core", "uk-stu-core-4", "肺结核检测证明", True, "检查后 1-3 天", "计划在英停留超过 6 个月必须提供（指定医院）", False),
    ("uk-student", "core", "uk-stu-core-5", "ATAS 证书", False, "20-30 工作日", "仅限特定敏感专业的本硕博申请者", False),
    ("uk-student", "financial", "uk-stu-fin-1", "银行存款证明", True, "存满28天", "金额=第一年学费+9个月生活费；必须连续存满28天", True),
    ("uk-student", "financial", "uk-stu-fin-2", "银行流水单", True, "存满28天", "证明资金存满28天的历史记录，最后交易日期在签证申请前31天内", True),
    ("uk-student", "financial", "uk-stu-fin-3", "父母同意信及出生证明", False, "1-3 工作日", "如资金在父母名下，需提供户口本/出生证及父母同意资助信", True),
    ("uk-student", "academic", "uk-stu-acad-1", "CAS 提到的学术材料", True, "已获得", "通常包括成绩单、毕业证、学位证原件及翻译件", True),
    ("uk-student", "academic", "uk-stu-acad-2", "语言成绩单", True, "已获得", "如 CAS 中明确要求，如 UKVI 雅思成绩单", False),
    ("uk-student", "supporting", "uk-stu-sup-1", "旧护照", False, "已获得", "如有必须提供", False),
    ("au-500", "core", "au-500-core-1", "有效护照", True, "首次 7-15 工作日", "彩色扫描件（首页及所有包含签证/印章的页面）", False),
    ("au-500", "core", "au-500-core-2", "COE (Confirmation of Enrolment)", True, "缴费后 1-2 周", "接受 Offer 并缴费后学校出具的入学确认信", False),
    ("au-500", "core", "au-500-core-3", "OSHC (海外学生健康保险)", True, "1-2 天", "必须覆盖整个签证有效期的保险凭证", False),
    ("au-500", "core", "au-500-core-4", "体检证明", True, "检查后 3-5 天", "建议在提交申请前通过 eMedical 系统提前体检", False),
    ("au-500", "core", "au-500-core-5", "GTE (真实临时入境者) 声明", True, "3-5 天", "撰写详细的 Personal Statement 证明留学目的真实性", True),
    ("au-500", "financial", "au-500-fin-1", "资金证明", True, "1-3 工作日", "需覆盖第一年的学费、生活费和差旅费；中国属较低风险等级通常不强制要求，但可能抽查", True),
    ("au-500", "academic", "au-500-acad-1", "最高学历证明", True, "1-2 周", "毕业证、学位证公证件或学校出具的中英文证明", True),
    ("au-500", "academic", "au-500-acad-2", "成绩单", True, "1-2 周", "中英文对照，加盖学校公章", True),
    ("au-500", "academic", "au-500-acad-3", "语言成绩单", False, "已获得", "雅思/托福等成绩单扫描件", False),
    ("au-500", "supporting", "au-500-sup-1", "出生公证", False, "1-2 周", "强烈建议提供（尤其是18岁以下申请人必须提供）", True),
    ("au-500", "supporting", "au-500-sup-2", "曾用名公证", False, "1-2 周", "如有曾用名必须提供", True),
]
VISA_TIPS = {
    "us-f1": ["面签回答简洁明了，不要背诵答案，只回答签证官问到的问题", "SEVIS 费需在面签前至少 3 天缴纳", "必须证明自己没有移民倾向，毕业后有明确回国计划", "如有拒签史，准备好合理解释，不要试图隐瞒"],
    "us-j1": ["注意 J-1 签证可能带有「两年回国服务限制」(212(e))", "建议提前了解保险要求，J-1 持有者必须购买符合规定的健康保险"],
    "uk-student": ["存款证明是英国签证最容易出错的环节，务必确保连续存满 28 天", "目前中国大陆申请人属于低风险国家，签证中心实行简化材料政策，但可能被抽查，建议全部备齐", "签证费和 IHS (医疗附加费) 均需在线缴纳"],
    "au-500": ["澳洲学生签证为纯电子签证，在线提交彩色扫描件，无需寄送原件", "GTE 声明是澳洲签证审核的核心，务必认真撰写回国动机", "请勿在签证下发前购买不可退改的机票"],
}

# ---- Fixed values: timelines. template, place, stage, name, time range, tasks, background, deadline, risk (None where there is none) ----
TIMELINES = [
    ("US-undergrad", 0, "stage-1", "探索与定位期", "高一上学期（9-12月）", ["确定课程体系（AP/IB/A-Level）", "初步选校方向调研", "启动英语能力提升"], "校内活动探索、兴趣领域调研。可开始探索科研方向，推荐参加入门级科研项目。", None, "⚠️ 不要盲目跟风选课，需结合自身优势和学校资源。"),
    ("US-undergrad", 1, "stage-2", "基础构建期", "高一下学期（1-6月）", ["GPA 严格管理，保持上升趋势", "标化首轮备考（托福/雅思）", "课外活动深入参与"], "参加入门级竞赛或学术项目，积累学术背景。", "AP 考试（5月）", None),
    ("US-undergrad", 2, "stage-3", "加速提升期", "高一暑假（7-8月）", ["参加暑期科研/夏校", "SAT/ACT 强化备考", "课外活动列表初建"], "🔑 暑期科研项目（核心提升窗口），深入特定学术领域。", "SAT 首考建议时间：高一暑假", "⚠️ 不要同时启动 3 门 AP + SAT 备考，容易 GPA 翻车。"),
    ("US-undergrad", 3, "stage-4", "深度打磨期", "高二上学期（9-12月）", ["标化成绩冲刺", "核心竞赛参与并争取奖项", "推荐人关系建立与维护"], "学科竞赛 + 深度科研，产出核心学术成果。", "SAT/ACT 目标出分（11-12月）", None),
    ("US-undergrad", 4, "stage-5", "申请准备期", "高二下学期至暑假（1-8月）", ["选校定校策略确认", "主文书构思与初稿撰写", "活动清单定稿与完善"], "🔒 科研论文/竞赛成果收尾，准备作为申请附加材料。", "Common App 开放（8月1日）", None),
    ("US-undergrad", 5, "stage-6", "申请冲刺期", "高三上学期（9-12月）", ["所有文书定稿", "网申系统填报与提交", "面试准备与模拟"], "专注于申请材料打磨，确保每一部分都完美呈现。", "ED 截止（11/1）、EA 截止（11/1-15）、RD 截止（1/1）", "⚠️ 密切关注各校具体截止时间，预留系统拥堵的缓冲时间。"),
    ("US-undergrad", 6, "stage-7", "收尾决策期", "高三下学期（1-5月）", ["等待录取结果", "对比 Offer，做出最终决定", "签证材料准备与申请"], "保持良好学术状态，避免最后一年 GPA 严重下滑。", "RD 放榜（3-4月）、确认入学（5/1）", None),
    ("US-master", 0, "stage-1", "规划与准备期", "大三上学期", ["确定申请专业方向", "制定语言和GRE/GMAT备考计划", "维持并提升GPA"], "寻找专业相关的实习机会或进入实验室跟进项目。", None, None),
    ("US-master", 1, "stage-2", "背景提升期", "大三下学期", ["参加语言和GRE/GMAT考试", "深入参与核心科研或实习", "初步筛选目标院校"], "🔑 争取获得一段高质量的专业对口实习或科研成果。", "争取在暑假前出一次可用的标化成绩", None),
    ("US-master", 2, "stage-3", "申请材料准备期", "大三暑假", ["敲定最终选校名单", "联系推荐人", "开始撰写PS和CV初稿"], "🔒 利用暑假进行高强度的核心实习或科研项目冲刺。", None, None),
    ("US-master", 3, "stage-4", "冲刺与提交期", "大四上学期", ["网申系统填报", "文书精修与定稿", "提交成绩单与语言成绩"], "确保所有申请材料准确无误。", "大多数项目截止日期集中在12月至次年1月", "⚠️ 注意各项目是否需要提交WES认证，预留充足时间。"),
    ("HK-master", 0, "stage-1", "探索定位期", "大三下学期", ["了解港校申请要求", "准备雅思/托福", "提升在校GPA"], "寻找对口的实习机会，港校非常看重实践经验。", None, None),
    ("HK-master", 1, "stage-2", "材料准备期", "大三暑假", ["准备申请文书(PS, CV)", "联系推荐人获取推荐信", "准备成绩单及在读证明"], "🔑 积累一段有含金量的专业实习。", None, None),
    ("HK-master", 2, "stage-3", "申请提交期", "大四上学期（9-12月）", ["港校网申开放，第一时间递交", "补充提交最新语言成绩", "准备可能出现的面试"], "🔒 准备好应对部分商科或社科项目的面试环节。", "港校多为滚动录取（Rolling），建议尽早申请！", "⚠️ 港校遵循先到先得原则，切勿拖延至最后期限。"),
]

# ---- Fixed values: the places that emit interaction events: event, category, label; None where the label is made of what was chosen ----
EVENT_SITES = [
    ("fill_example_courses", "Engagement", "GPA Calculator"),
    ("switch_algorithm", "Engagement", None),
    ("generate_pdf_report", "Engagement", "GPA Calculator PDF"),
    ("click_cta_button", "Engagement", None),
    ("copy_wechat_id", "Conversion", "GPA Calculator"),
    ("select_country", "Engagement", None),
    ("select_accommodation", "Engagement", None),
    ("generate_cost_saving_plan", "Engagement", "Cost Calculator Plan"),
    ("click_cta_button", "Engagement", None),
    ("copy_wechat_id", "Conversion", "Cost Calculator"),
    ("generate_timeline", "Engagement", None),
    ("share_timeline_image", "Engagement", None),
    ("click_timeline_lock_cta", "Engagement", None),
    ("copy_wechat_id", "Conversion", "Timeline Generator"),
]
# the events that carry a value, and the labels of the timeline's locks
VALUED_EVENTS = ["generate_pdf_report", "click_cta_button", "generate_cost_saving_plan"]
LOCK_LABELS = ["mid-lock", "bottom-download"]
# what the buttons say at each tier of the GPA and of the costs
GPA_BUTTONS = {"top": "获取选校报告", "good": "定制背景提升方案", "low": "查看逆袭方案", "none": "免费评估"}
COST_BUTTONS = {"plan": "免费规划", "guide": "获取免费指南"}

# ---- Fixed values: the courses that "fill example" puts in: name, credits, score ----
EXAMPLE_COURSES = [("高等数学", 4.0, 85.0), ("大学物理", 3.0, 78.0), ("计算机网络", 3.0, 92.0)]


# ---------------------------------------------------------------- rows


def band_rows(scales: dict = SCALES) -> list[tuple]:
    """A row for each band; a scale without a name of its own has its id for one."""
    return [(k, SCALE_NAMES.get(k, k), top, float(bound), points) for k, (top, bands) in scales.items() for bound, points in bands]


def school_rows() -> list[tuple]:
    return [(pos, *r) for pos, r in enumerate(SCHOOLS)]


def visa_rows() -> list[tuple]:
    """One nested row for each country: its visas, their fees, and their materials by section."""
    out: dict[str, tuple] = {}
    for country, country_name, code, kind, name, about, time, *fees in VISAS:
        sections = [[r[2:] for r in VISA_ITEMS if r[:2] == (code, section)] for section in SECTIONS]
        row = out.setdefault(country, (country, country_name, []))
        row[2].append((code, kind, name, about, time, tuple(fees), (*sections, VISA_TIPS[code])))
    return list(out.values())


def flat_visa_rows() -> list[tuple]:
    """country, visa, section number, item number, item, name, required, preparation, notes, translation."""
    return [
        (country, code, s, i, *item)
        for country, _, visas in visa_rows()
        for code, *_, materials in visas
        for s, section in enumerate(materials[:4])
        for i, item in enumerate(section)
    ]


def stage_rows() -> list[tuple]:
    return list(TIMELINES)


# ---------------------------------------------------------------- tables

_FEE = "struct<amount:int,currency:string,cny:int>"
_ITEM = "array<struct<id:string,name:string,required:boolean,prep_time:string,notes:string,needs_translation:boolean>>"


def grade_scales(spark: SparkSession, scales: dict = SCALES) -> DataFrame:
    return spark.createDataFrame(band_rows(scales), "scale_id string, scale_name string, max_gpa_x10 int, lower_bound double, points_x10 int")


def cost_countries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COUNTRIES, "country_id string, country_name string, flag string, currency string, rate double, application_fee int, hidden_fee int")


def cost_cities(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CITIES, "country_id string, pos int, city_id string, city_name string, living_mult double, accom_base double")


def cost_degrees(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEGREES, "country_id string, degree string, public_tuition double, private_tuition double, default_duration double")


def accommodations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ACCOMMODATIONS, "accommodation string, accommodation_name string, multiplier double")


def degree_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEGREE_TYPES, "degree string, degree_name string")


def school_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SCHOOL_TYPES, "school_type string, school_type_name string")


def schools(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(school_rows(), "pos int, school_id string, name string, en_name string, country string, ranking int, req_gpa double, req_toefl int, req_ielts double, tags array<string>")


def background_adjustments(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BACKGROUNDS, "bg_code string, gpa_adj double")


def visa_catalog(spark: SparkSession) -> DataFrame:
    materials = f"struct<core:{_ITEM},financial:{_ITEM},academic:{_ITEM},supporting:{_ITEM},tips:array<string>>"
    visa = f"array<struct<visa_id:string,type:string,type_name:string,description:string,processing_time:string,fees:struct<visa_fee:{_FEE},sevis_fee:{_FEE},ihs_fee:{_FEE}>,materials:{materials}>>"
    return spark.createDataFrame(visa_rows(), f"country_id string, country_name string, visas {visa}")


def timeline_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(stage_rows(), "template_id string, idx int, stage_id string, stage_name string, time_range string, core_tasks array<string>, bg_enhancement string, deadline string, risk_warning string")


def literal(v) -> str:
    """A value as SQL; doubles keep their type."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).upper()
    if isinstance(v, (list, tuple)):
        return "[" + ", ".join(map(literal, v)) + "]"
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"


def values(name: str, columns: str, rows: list[tuple]) -> str:
    """A common table expression of constant rows."""
    return f"{name}({columns}) AS (VALUES " + ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows) + ")"
